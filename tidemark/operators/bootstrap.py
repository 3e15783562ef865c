"""Stationary block bootstrap of daily sums, from random streams that every engine can draw.

Random numbers depend on (seed, repetition, draw) alone: two 52-bit parts of an md5,
so that any engine, partitioning or rerun draws the same ones. A repetition is a row of
blocks, each with a uniform first day and a geometric length, days in a circle, until
there are as many days as the sample has. A block's sums are differences of running
sums, so a block costs two look-ups however long it is, and a repetition about
days / block of them.

A comparison is a row of its days' running sums for each chunk of repetitions, so that one
with many days or repetitions is spread over tasks; a task draws a chunk's numbers once for
all comparisons. Rows go through numpy one by one, and none holds more than its days.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stored

CHUNK = 50
FEWEST_DAYS = 3
#: Means that differ by less are equal: what is left is rounding.
NO_SPREAD = 1e-18
#: A mean this near to the measured difference counts as equal to it, whatever the order of its sums.
TIE = 1e-12

#: Coefficients of algorithm AS241 for the normal quantile (fixed values, constant term last): centre, middle and far numerators and denominators.
CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080),
    (5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867, 5394.1960214247511077, 687.18700749205790830, 42.313330701600911252, 1.0),
)
MIDDLE = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.241780725177450611770, 1.27045825245236838258, 3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.148103976427480074590, 0.689767334985100004550, 1.67638483018380384940, 2.05319162663775882187, 1.0),
)
FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.00124266094738807843860, 0.0265321895265761230930, 0.296560571828504891230, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 0.0148753612908506148525, 0.136929880922735805310, 0.599832206555887937690, 1.0),
)


def ratio_sql(coefficients: tuple, at: str) -> str:
    """A ratio of two polynomials in ``at``, by Horner's rule."""

    def polynomial(values: tuple) -> str:
        # An exponent makes a literal a double in both engines.
        first, *rest = (repr(v) if "e" in repr(v) else f"{v!r}e0" for v in values)
        for v in rest:
            first = f"({first} * {at} + {v})"
        return first

    return f"({polynomial(coefficients[0])} / {polynomial(coefficients[1])})"


def z_of_p_sql(p: str) -> str:
    """Two-sided z of the p-value column ``p``; 8 where there is none or it is 0. The text is both engines' SQL."""
    half = f"least({p} / 2, 1 - 1e-16)"
    q, r = f"({half} - 0.5e0)", f"sqrt(-ln(least({half}, 1 - {half})))"
    near = f"{ratio_sql(CENTRE, f'(0.180625e0 - {q} * {q})')} * {q}"
    tail = f"CASE WHEN {r} <= 5 THEN {ratio_sql(MIDDLE, f'({r} - 1.6e0)')} ELSE {ratio_sql(FAR, f'({r} - 5e0)')} END"
    return f"CASE WHEN {p} IS NULL OR {p} <= 0 THEN 8e0 WHEN abs({q}) <= 0.425e0 THEN abs({near}) ELSE abs({tail}) END"


def uniform(digits: Column) -> Column:
    """The first 52 bits of hex digits as a number in [0, 1)."""
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("long") / float(1 << 52)


def draws(chunk: int, reps: int, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each repetition of a chunk ``most`` draws: uniform numbers for the first days, and ln(1 - uniform) for the lengths."""
    rows = range(chunk * CHUNK, min(reps, (chunk + 1) * CHUNK))
    digits = [md5(f"{seed}:{rep}:{j}".encode()).hexdigest() for rep in rows for j in range(most)]
    u, v = (np.array([int(d[at : at + 13], 16) for d in digits], float).reshape(len(rows), most) / (1 << 52) for at in (0, 13))
    return u, np.log(1 - v)


def most_draws(days: Column, block: Column) -> Column:
    """So many draws at most make up a repetition; beyond ten deviations the last block takes what is left."""
    share = days / block
    return F.least(days, F.ceil(share + 10 * F.sqrt(share) + 30)).cast("int")


def chunk_means(sums: np.ndarray, counts: np.ndarray, block: int, most: int, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The mean of each repetition over days with these running sums and counts."""
    t = len(sums)
    u, w = u[:, :most], w[:, :most]
    length = 1 + np.floor(w / np.log(1 - 1.0 / block)).astype(np.int64)
    done = np.minimum(np.cumsum(length, 1), t)
    done[:, -1] = t
    length = np.diff(done, axis=1, prepend=0)
    first = np.floor(u * t).astype(np.int64)
    end = first + length
    past = end > t
    total = []
    for running in (sums, counts):
        prefix = np.concatenate([[0], running])
        total.append((prefix[np.where(past, end - t, end)] - prefix[first] + past * running[-1]).sum(1))
    return total[0] / total[1]


def resampled(cells: DataFrame, keys: Sequence[str], horizon: Column, reps: int, seed: int) -> DataFrame:
    """From daily cells one comparison a key: value, baseline_value, delta, n, n_eff, p_value.

    A comparison holds one row a day. Below three days there is no p-value and every observation counts.
    """
    so_far = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = cells.select(*keys, "day", "n", "model", "base", "d", "dd", horizon.alias("__h"), F.sum("d").over(so_far).alias("sum"), F.sum("n").over(so_far).alias("count"))
    days = F.array_sort(F.collect_list(F.struct("day", "sum", "count")))
    grouped = running.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("t"), F.first("__h").alias("__h"), *(F.sum(c).alias(c) for c in ("n", "model", "base", "d", "dd")), days.alias("days"))
    n, mean = F.col("n"), F.col("d") / F.col("n")
    own = F.when(n > 1, (F.col("dd") - n * mean * mean) / (n - 1)).otherwise(0.0)
    found = grouped.select(*keys, "t", n, (F.col("model") / n).alias("value"), (F.col("base") / n).alias("baseline_value"), mean.alias("delta"), own.alias("own"), F.col("days.sum").alias("sums"), F.col("days.count").alias("counts"), F.greatest(F.lit(2), F.least(F.col("__h").cast("int"), F.floor(F.col("t") / 2).cast("int"))).alias("block"))
    found = stored(found.withColumn("most", most_draws(F.col("t"), F.col("block"))), "comparisons")

    chunks = -(-reps // CHUNK)
    asked = found.where(F.col("t") >= FEWEST_DAYS).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = asked.select(*keys, "delta", "chunk", "block", "most", "sums", "counts").repartition(chunks, "chunk").sortWithinPartitions("chunk", F.col("most").desc())

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, drawn = -1, None
        for batch in batches:
            means = []
            for chunk, block, most, sums, counts in zip(*(batch.column(c) for c in ("chunk", "block", "most", "sums", "counts")), strict=True):
                if chunk.as_py() != at:
                    at, drawn = chunk.as_py(), draws(chunk.as_py(), reps, most.as_py(), seed)
                means.append(chunk_means(sums.values.to_numpy(), counts.values.to_numpy(), block.as_py(), most.as_py(), *drawn))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*keys, "delta")), pa.array(means, pa.list_(pa.float64()))], names=[*keys, "delta", "means"])

    fields = [asked.schema[c] for c in (*keys, "delta")]
    means = asked.mapInArrow(repeat, T.StructType([*fields, T.StructField("means", T.ArrayType(T.DoubleType()))])).select(*keys, "delta", F.explode("means").alias("m"))
    off, far = F.col("m") - F.col("delta"), F.abs("delta")
    # Keys may be null, so both parts meet in one grouping and not in a join.
    tails = means.groupBy(*keys).agg(F.count_if(off <= -far + TIE).alias("low"), F.count_if(off >= far - TIE).alias("high"), F.var_samp("m").alias("spread"))
    what = ("t", "n", "value", "baseline_value", "delta", "own")
    both = found.select(*keys, F.struct(*what).alias("own"), F.lit(None).cast("struct<low:bigint,high:bigint,spread:double>").alias("tails"))
    both = both.unionByName(tails.select(*keys, F.lit(None).cast(both.schema["own"].dataType).alias("own"), F.struct("low", "high", "spread").alias("tails")))
    one = both.groupBy(*keys).agg(F.max("own").alias("o"), F.max("tails").alias("s"))
    effective = F.when(F.coalesce(F.col("s.spread"), F.lit(0.0)) > NO_SPREAD, F.least(F.greatest(F.col("o.own") / F.col("s.spread"), F.lit(1.0)), F.col("o.n"))).otherwise(F.col("o.n"))
    p = F.least(F.lit(1.0), F.greatest(F.lit(1.0 / reps), 2 * F.least("s.low", "s.high") / F.lit(reps)))
    return one.select(*keys, "o.value", "o.baseline_value", "o.delta", "o.n", effective.cast("double").alias("n_eff"), F.when(F.col("s").isNotNull(), p).alias("p_value"))


def resampled_sql(rows: str, keys: Sequence[str], horizon: str = "horizon", day: str = "session", reps: int = 2000, seed: int = 7) -> str:
    """The same as common table expressions in DuckDB's SQL, from ``rows`` (keys, day, m, b) to ``compared``."""
    k = ", ".join(keys)
    same = " AND ".join(f"c.{x} IS NOT DISTINCT FROM g.{x}" for x in keys)
    return f"""
    bc AS MATERIALIZED (SELECT {k}, {day} AS day, count(*) AS n, sum(m) AS m, sum(b) AS b, sum(m - b) AS d, sum((m - b) * (m - b)) AS dd FROM {rows} GROUP BY {k}, {day}),
    bg AS MATERIALIZED (
        SELECT *, row_number() OVER () AS g, greatest(2, least({horizon}, t // 2))::BIGINT AS block,
               CASE WHEN n > 1 THEN (dd - n * delta * delta) / (n - 1) ELSE 0.0 END AS own
        FROM (SELECT {k}, count(*) AS t, sum(n)::BIGINT AS n, sum(d) AS d, sum(m) / sum(n) AS value, sum(b) / sum(n) AS baseline_value, sum(d) / sum(n) AS delta, sum(dd) AS dd FROM bc GROUP BY {k})),
    bp_at AS MATERIALIZED (SELECT *, (g - 1) * (SELECT max(t) + 1 FROM bg) AS shift FROM bg),
    bp AS MATERIALIZED (
        SELECT shift + row_number() OVER w AS k, sum(d) OVER w AS pd, sum(n) OVER w AS pn
        FROM (SELECT g.g, g.shift, c.day, c.d, c.n FROM bc c JOIN bp_at g ON {same}) WINDOW w AS (PARTITION BY g ORDER BY day ROWS UNBOUNDED PRECEDING)
        UNION ALL SELECT shift, 0.0, 0 FROM bp_at),
    bs AS MATERIALIZED (SELECT t, block, least(t, ceil(t / block + 10 * sqrt(t / block) + 30))::BIGINT AS most FROM (SELECT DISTINCT t, block FROM bg WHERE t >= {FEWEST_DAYS})),
    br AS MATERIALIZED (
        SELECT rep, j, ('0x' || substr(h, 1, 13))::BIGINT / {1 << 52}.0::DOUBLE AS u, ln(1 - ('0x' || substr(h, 14, 13))::BIGINT / {1 << 52}.0::DOUBLE) AS w
        FROM (SELECT rep, j, md5('{seed}:' || rep || ':' || j) AS h FROM range({reps}) a(rep), (SELECT unnest(range((SELECT coalesce(max(most), 1) FROM bs))) AS j))),
    bl AS (
        SELECT t, block, most, rep, j, floor(u * t)::BIGINT AS s, 1 + floor(w / ln(1 - 1.0::DOUBLE / block))::BIGINT AS l FROM bs JOIN br ON j < most),
    bd AS (SELECT *, sum(l) OVER (PARTITION BY t, block, rep ORDER BY j ROWS UNBOUNDED PRECEDING) - l AS done FROM bl),
    bu AS (SELECT t, block, rep, s, s + CASE WHEN j = most - 1 THEN t - done ELSE least(l, t - done) END AS e FROM bd WHERE done < t),
    bm AS (
        SELECT g.g, rep, sum(y.pd - x.pd + CASE WHEN e > u.t THEN g.d ELSE 0 END) / sum(y.pn - x.pn + CASE WHEN e > u.t THEN g.n ELSE 0 END) AS mean
        FROM bu u JOIN bp_at g ON g.t = u.t AND g.block = u.block JOIN bp x ON x.k = g.shift + s
        JOIN bp y ON y.k = g.shift + CASE WHEN e > u.t THEN e - u.t ELSE e END GROUP BY g.g, rep),
    bt AS (SELECT g, count(*) FILTER (mean - delta <= -abs(delta) + {TIE}) AS low, count(*) FILTER (mean - delta >= abs(delta) - {TIE}) AS high, var_samp(mean) AS spread FROM bm JOIN bg USING (g) GROUP BY g),
    compared AS (
        SELECT {k}, value, baseline_value, delta, n, CASE WHEN spread > {NO_SPREAD} THEN least(greatest(own / spread, 1.0), n) ELSE n END::DOUBLE AS n_eff,
               CASE WHEN t >= {FEWEST_DAYS} THEN least(1.0, greatest(1.0 / {reps}, 2 * least(low, high) / {reps}.0)) END AS p_value
        FROM bg LEFT JOIN bt USING (g))"""
