"""The registered queries on the driver's small tables, and the pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def value(x):
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        p = f"{SF}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    want = con.sql(queries.ORACLES[name])
    cols = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(tuple(map(value, r)) for r in got.select(*cols).collect()) == sorted(tuple(value(r[want.columns.index(c)]) for c in cols) for r in want.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def by_hand(spark, name, docs, after):
    """What a stage must give for ``docs``, worked out in plain Python from the rows alone."""
    from collections import Counter

    import pyarrow as pa
    from test_small_operators import loads_by_hand, near_by_hand

    from tidemark.llm import decontaminate, mixing, toxicity

    rows = [tuple(r) for r in docs.collect()]
    if name == "toxicity":
        model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
        return Counter(r for r in rows if model.scores(pa.array([r[1] or ""]))[0] < 0.7)
    if name == "near_dedup":
        found = near_by_hand([r[:2] for r in rows], 5, 80)
        return Counter(r for r in rows if found[r[0]][1] == r[0])
    if name == "decontaminate":
        words = lambda t: decontaminate.word_hashes(pa.array([(t or "").lower()]), ascii_words_only=True)[0]
        items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
        return Counter(r for r in rows if all(decontaminate.align(i, words(r[1]))[0] < len(i) for i in items))
    if name == "mix":
        taken = {r.doc_id: r for r in mixing.mix(docs, corpus_pipeline.MIX_WEIGHTS, corpus_pipeline.MIX_EPOCHS, corpus_pipeline.MIX_SEED).collect()}
        return Counter({r: 1 if not taken[r[0]]["size"] else -(-taken[r[0]]["taken"] // taken[r[0]]["size"]) for r in rows})
    groups, load = Counter(), Counter()
    for r in rows:
        groups[r[1] or ""] += len((r[1] or "").encode()) + 1
    for r in after.collect():
        load[r["shard"]] += r["size"]
    assert load == loads_by_hand(list(groups.values()), 16)
    return Counter(rows)


def test_pipeline(spark):
    """Stage by stage, each on what the one before kept, against plain Python."""
    from collections import Counter

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).checkpoint()
        if name != "shard":
            assert after.columns == docs.columns
        want = by_hand(spark, name, before, after)
        assert Counter(tuple(r) for r in after.select(docs.columns).collect()) == +want, name
        seen.append((name, before.count(), after.count()))
        before = after
    assert [n for n, *_ in seen] == ["toxicity", "near_dedup", "decontaminate", "mix", "shard"]
    assert all(b < a for n, a, b in seen if n in ("toxicity", "near_dedup"))
    for k in range(16):
        own = before.where(f"shard = {k}")
        assert sorted(r["slot"] for r in own.select("slot").collect()) == list(range(own.count()))


def test_stages_take_awkward_rows_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "six words of text in here", "en", "a", 9), (3, "six words of text in here", "en", "a", 9), (None, "no id but words", None, "b", None), (5, "w " * 30_000, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"size": F.lit("s"), "shard": F.lit("t"), "n": F.lit(1), "id": F.lit("u"), "taken": F.lit(2), "words": F.lit(3)})
    for table, least in ((docs, 3), (docs.where("false"), 0)):
        for name, stage in corpus_pipeline.STAGES:
            table_after = stage(spark, table, SF)
            if name == "near_dedup" and least:
                assert sorted(str(r.doc_id) for r in table_after.collect()) == ["1", "2", "3", "5", "None"]
            assert table_after.count() >= least
            if name != "shard":
                assert table_after.columns == docs.columns
            else:
                assert sorted(set(table_after.columns)) == sorted(table_after.columns) and "slot" in table_after.columns
            table = table_after


def test_near_duplicates_judge_rows_of_one_id_by_their_texts(spark):
    long = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"other{i}" for i in range(40))
    rows = [(1, long), (1, other), (1, other), (2, long + " more"), (3, "short text"), (None, other), (None, other), (4, None), (4, None), (5, "")]
    docs = spark.createDataFrame([(*r, "s", {"k": 1}, "p") for r in rows], "doc_id long, text string, source string, tags map<string,int>, __place string")
    found = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert found.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in found.collect())
    # Of the two linked texts the one under the plain id 2 stays; 1's other text stays once, null texts of one id are equal.
    assert got == sorted([(False, 2, long + " more"), (False, 1, other), (False, 3, "short text"), (True, 0, other), (True, 0, other), (False, 4, ""), (False, 5, "")])
    once = spark.createDataFrame([(*r, "s", {"k": 1}, "p") for r in [(1, long), (2, long + " more"), (3, other)]], docs.schema)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, once, SF).collect()) == [1, 3]
