"""Toxicity: logistic regression on words and word beginnings, regularised by counterfactuals.

Features are hashes of lower-cased words and of their first 4 to 8 bytes (a word and
its inflections share them), as log counts per thousand words. The training
sample picks the ``vocabulary`` features that tell the classes apart best; those
of the identity terms always belong to them.

Twins are sentences of labelled texts. A sentence that names a group of people
gets a twin with the name swapped for another of the same language and number.
Of every text one sentence is also given a name that it doesn't have, and that
has two twins: with another name in its place, and with none. All three count
as of one length. The fit penalises the squared difference of twins' scores
besides the usual loss and ridge. The given names of clean texts are labelled
rows too, neutral mentions with label 0. So naming a group moves no score,
whatever the labels happen to correlate with, and the penalty acts on every fit,
also where no text names a group. ``mention_report`` measures it.

Defined results: null and empty texts are scored by the intercept; very long texts
are scored whole; repeated rows are scored alike; labels of one id that differ count
as toxic; of features that tell apart equally well the smaller hashes are taken;
without both kinds of label every score is the share of label 1 (0 without labels);
an empty table gives an empty result; only the named columns are read, whatever the
others' names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labels import training_sample
from tidemark.llm.wordhash import buffers, byte_values, mix64, pieces, powers, word_hashes
from tidemark.session import modest_batches

#: Names of groups of people that may stand for one another in a sentence: by language, and by number or as adjectives.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "foreigners", "africans", "asians", "europeans", "americans", "arabs", "gays", "lesbians"),
    ("woman", "man", "girl", "boy", "christian", "muslim", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee", "foreigner", "african", "asian", "european", "american", "arab", "lesbian"),
    ("black", "white", "brown", "indigenous", "disabled", "elderly", "deaf", "blind", "gay", "bisexual", "transgender", "jewish", "female", "male"),
    ("frauen", "männer", "christen", "muslime", "juden", "hindus", "flüchtlinge", "ausländer", "einwanderer", "behinderte"),
    ("frau", "mann", "christ", "muslim", "jude", "flüchtling", "ausländerin", "einwanderin"),
    ("femmes", "hommes", "chrétiens", "musulmans", "juifs", "immigrés", "réfugiés", "étrangers", "handicapés"),
    ("femme", "homme", "chrétien", "musulman", "juif", "immigré", "réfugié", "étranger"),
    ("mujeres", "hombres", "cristianos", "musulmanes", "judíos", "inmigrantes", "refugiados", "extranjeros"),
    ("mujer", "hombre", "cristiano", "musulmán", "judío", "inmigrante", "refugiado", "extranjero"),
)
PREFIXES = (4, 5, 6, 7, 8)
FILTER_BITS = 20
PARTS = 16


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A (words, 1 + prefixes) table of hashes, 0 where a word has no such beginning, and each text's first word."""
    words, first, starts = word_hashes(texts, lower=True, ascii_words_only=True)
    out = np.zeros((len(words), 1 + len(PREFIXES)), np.uint64)
    out[:, 0] = words
    if not len(words):
        return out, first
    data, _ = buffers(texts)
    values = byte_values(True, True)
    longest = np.arange(max(PREFIXES))
    up, _ = powers(1 << 20)
    for low in range(0, len(words), 1 << 16):
        at = starts[low : low + (1 << 16)]
        places = np.minimum(at[:, None] + longest, len(data) - 1)
        got = values[data[places]]
        # Bytes past the word's end count as none, and so does everything after them.
        inside = np.logical_and.accumulate((got != 0) & (at[:, None] + longest < len(data)), axis=1)
        sums = np.cumsum(np.where(inside, got, 0) * up[: max(PREFIXES)], axis=1, dtype=np.uint64)
        for k, p in enumerate(PREFIXES):
            whole = inside[:, p - 1]
            out[low : low + len(at), 1 + k] = np.where(whole, mix64(sums[:, p - 1] + np.uint64(p)), 0)
    return out, first


GROUP_OF = {t: g for g in reversed(IDENTITY_GROUPS) for t in g}
_TERM = re.compile(r"\b(" + "|".join(sorted(GROUP_OF, key=len, reverse=True)) + r")\b", re.IGNORECASE)
_SENTENCE = re.compile(r"[^.!?\n]+")


def other_term(term: str, seed: str) -> str:
    """Another name of the term's own group."""
    group = GROUP_OF[term.lower()]
    step = 1 + crc32(seed.encode()) % (len(group) - 1)
    return group[(group.index(term.lower()) + step) % len(group)]


def counterfactual(sentence: str) -> str | None:
    """``sentence`` with each identity term swapped for another of its group, None where it names none."""

    def swap(m: re.Match) -> str:
        new = other_term(m[0], f"{m.start()}:{len(sentence)}")
        return new.upper() if m[0].isupper() else new.capitalize() if m[0][:1].isupper() else new

    out, n = _TERM.subn(swap, sentence)
    return out if n else None


def planted(text: str) -> tuple[str, str, str] | None:
    """One sentence of ``text``, and it with two names of one group in one place. None where there is no sentence."""
    sentences = [m[0].strip() for m in _SENTENCE.finditer(text) if m[0].strip()]
    if not sentences:
        return None
    seed = crc32(text.encode())
    words = sentences[seed % len(sentences)].split()
    group = IDENTITY_GROUPS[seed // 7 % len(IDENTITY_GROUPS)]
    term, at = group[seed // 91 % len(group)], seed // 13 % (len(words) + 1)
    named = lambda t: " ".join([*words[:at], t, *words[at:]])
    return " ".join(words), named(term), named(other_term(term, str(seed)))


def identity_keys() -> np.ndarray:
    """The features of all identity terms."""
    found = np.unique(word_features(pa.array(sorted(GROUP_OF), pa.string()))[0])
    return found[found != 0]


@dataclass
class ToxicityModel:
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.keys & np.uint64((1 << FILTER_BITS) - 1)] = True

    def sparse(self, texts: pa.Array, words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, key, value) of all features that are in the vocabulary. ``words``: the lengths that texts count as."""
        table, first = word_features(texts)
        hit = np.argwhere(self.maybe[table & np.uint64((1 << FILTER_BITS) - 1)])
        h = table[hit[:, 0], hit[:, 1]]
        at = np.minimum(np.searchsorted(self.keys, h), max(0, len(self.keys) - 1))
        real = self.keys[at] == h if len(self.keys) else np.zeros(len(h), bool)
        owner = np.searchsorted(first, hit[real, 0], side="right") - 1
        pair, count = np.unique(owner * max(1, len(self.keys)) + at[real], return_counts=True)
        rows, cols = np.divmod(pair, max(1, len(self.keys)))
        words = np.maximum(np.diff(first) if words is None else words, 1)
        return rows, cols, np.log1p(1000 * count / words[rows])

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows, cols, values = self.sparse(texts)
        return 1 / (1 + np.exp(-np.clip(self.bias + np.bincount(rows, values * self.weights[cols], minlength=len(texts)), -35, 35)))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that have each feature, summed by batch."""
    for batch in pieces(batches, 0):
        table, first = word_features(batch.column(0))
        y = batch.column(1).to_numpy()
        found = [np.unique(table[a:b]) for a, b in pairwise(first)]
        keys = np.concatenate(found) if found else np.zeros(0, np.uint64)
        label = np.repeat(y, [len(f) for f in found])
        unique, back = np.unique(keys, return_inverse=True)
        toxic = np.bincount(back, label, minlength=len(unique)).astype(np.int64)
        every = np.bincount(back, minlength=len(unique))
        real = unique != 0
        yield pa.RecordBatch.from_arrays([pa.array(unique[real].view(np.int64)), pa.array(toxic[real]), pa.array(every[real])], names=["key", "toxic", "every"])


VECTORS = "y double, weight double, cols array<int>, vals array<double>, twin_cols array<int>, twin_vals array<double>"


def _vectors(model: ToxicityModel, mention_weight: float):
    """The labelled rows (each text, and clean texts' sentences with a name) and the pairs of twins. A row may be both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            every, lengths, rows = list(texts), [-1] * len(texts), [(y, 1.0, i, None) for i, y in enumerate(labels)]

            def add(sentence: str, words: int) -> int:
                every.append(sentence)
                lengths.append(words)
                return len(every) - 1

            for text, y in zip(texts, labels, strict=True):
                for m in _SENTENCE.finditer(text) if _TERM.search(text) else ():
                    if (twin := counterfactual(m[0])) is not None:
                        n = len(m[0].split())
                        rows.append((None, 0.0, add(m[0], n), add(twin, n)))
                if (three := planted(text)) is not None:
                    n = len(three[0].split()) + 1
                    none, one, other = (add(x, n) for x in three)
                    rows.append((0.0 if y == 0 else None, mention_weight, one, none))
                    rows.append((None, 0.0, one, other))
            both = pa.array(every, pa.string())
            own = np.diff(word_hashes(both, lower=True, ascii_words_only=True)[1])
            at, cols, values = model.sparse(both, np.where(np.array(lengths) < 0, own, lengths))
            cut = np.searchsorted(at, np.arange(len(both) + 1))
            lists = [(cols[a:b].tolist(), values[a:b].tolist()) for a, b in pairwise(cut)]
            of = lambda k, part: [None if r[k] is None else lists[r[k]][part] for r in rows]
            kinds = (pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.float64()))
            out = [[r[0] for r in rows], [r[1] for r in rows], of(2, 0), of(2, 1), of(3, 0), of(3, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["y", "weight", "cols", "vals", "twin_cols", "twin_vals"])

    return run


def minimise(value_and_slope, x: np.ndarray, rounds: int = 80, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with backtracking."""
    f, g = value_and_slope(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, alphas = g.copy(), []
        for s, t in reversed(steps):
            alphas.append((s @ q) / (s @ t))
            q -= alphas[-1] * t
        if steps:
            s, t = steps[-1]
            q *= (s @ t) / (t @ t)
        for (s, t), a in zip(steps, reversed(alphas), strict=True):
            q += s * (a - (t @ q) / (s @ t))
        slope, rate = -(q @ g), 1.0
        while True:
            x2 = x - rate * q
            f2, g2 = value_and_slope(x2)
            if f2 <= f + 1e-4 * rate * slope or rate < 1e-8:
                break
            rate /= 2
        done = f - f2 < 1e-9 * max(1, abs(f))
        if (x2 - x) @ (g2 - g) > 1e-12:
            steps = [*steps[1 - memory :], (x2 - x, g2 - g)]
        x, f, g = x2, f2, g2
        if done:
            break
    return x


def _fit(rows: list, keys: int, ridge: float, fairness: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the least weighted log loss + ridge / 2 * |w|^2 + fairness / 2 * sum of the twins' squared differences."""

    def flat(some: list, cols: str, vals: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(some)), [len(r[cols]) for r in some]).astype(np.int64)
        join = lambda name, kind: np.concatenate([np.asarray(r[name], kind) for r in some]) if some else np.zeros(0, kind)
        return owner, join(cols, np.int64), join(vals, float)

    known, pairs = [r for r in rows if r["y"] is not None], [r for r in rows if r["twin_cols"] is not None]
    y, weight = np.array([r["y"] for r in known]), np.array([r["weight"] for r in known])
    own = flat(known, "cols", "vals")
    gap = tuple(np.concatenate(x) for x in zip(flat(pairs, "cols", "vals"), (lambda o, c, v: (o, c, -v))(*flat(pairs, "twin_cols", "twin_vals")), strict=True))

    def value_and_slope(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:-1], x[-1]
        z = b + np.bincount(own[0], own[2] * w[own[1]], minlength=len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        d = np.bincount(gap[0], gap[2] * w[gap[1]], minlength=len(pairs))
        loss = np.sum(weight * (np.logaddexp(0, z) - y * z)) + 0.5 * ridge * (w @ w) + 0.5 * fairness * (d @ d)
        slope = np.bincount(own[1], own[2] * (weight * (p - y))[own[0]], minlength=keys) + ridge * w + fairness * np.bincount(gap[1], gap[2] * d[gap[0]], minlength=keys)
        return loss, np.append(slope, np.sum(weight * (p - y)))

    share = (weight @ y) / weight.sum()
    x = minimise(value_and_slope, np.append(np.zeros(keys), np.log(share / (1 - share))))
    return x[:-1], float(x[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_rows: int = 12_000, vocabulary: int = 2048, least_docs: int = 3, ridge: float = 0.3, fairness: float = 4.0, mention_weight: float = 0.25, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on at most about ``train_rows`` labelled rows. Their vectors over the vocabulary come to the driver."""
    sample = training_sample(docs, labels, label, train_rows, id_col, text_col).repartition(PARTS, "id").persist()
    try:
        total, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
        if not 0 < toxic < total:
            return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 35.0 if total and toxic == total else -35.0)
        counts = sample.select("text", "y").mapInArrow(_counts, "key long, toxic long, every long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("every").alias("every"))
        # Log-likelihood ratio of the feature against independence of it and the label.
        a, n = F.col("toxic").cast("double"), F.col("every").cast("double")
        cell = lambda seen, rows, share: seen * F.ln((seen + 0.5) / (rows * share + 0.5))
        gain = cell(a, n, toxic / total) + cell(n - a, n, 1 - toxic / total) + cell(toxic - a, total - n, toxic / total) + cell(total - n - toxic + a, total - n, 1 - toxic / total)
        best = counts.where(F.col("every") >= least_docs).orderBy(gain.desc(), "key").limit(vocabulary).select("key").collect()
        keys = np.union1d(np.array([r["key"] for r in best], np.int64).view(np.uint64), identity_keys())
        model = ToxicityModel(keys, np.zeros(len(keys)), 0.0)
        rows = sample.select("text", "y").mapInArrow(_vectors(model, mention_weight), VECTORS).collect()
        weights, bias = _fit(rows, len(keys), ridge, fairness)
        return ToxicityModel(keys, weights, bias)
    finally:
        sample.unpersist()


def _mentions(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            three = [x for text in batch.column(0).to_pylist() if (x := planted(text)) is not None]
            none, one, other = (model.value.scores(pa.array([x[k] for x in three], pa.string())) for k in range(3))
            sums = (len(three), np.abs(one - none).sum(), np.abs(one - other).sum(), int((one >= threshold).sum()))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums], names=["mentions", "none", "other", "taken"])

    return run


def mention_report(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """One row on names given to one sentence of each text: mentions, mean_gap_none and mean_gap_other (the mean change of score against no name and another), rejected_share. For clean texts the last is the rate of false positives on neutral mentions."""
    modest_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(_mentions(sent, threshold), "mentions long, none double, other double, taken long")
    total = found.agg(*(F.sum(c).alias(c) for c in found.columns))
    return total.select("mentions", (F.col("none") / F.col("mentions")).alias("mean_gap_none"), (F.col("other") / F.col("mentions")).alias("mean_gap_other"), (F.col("taken") / F.col("mentions")).alias("rejected_share"))


def _below(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = model.value.scores(batch.column(batch.num_columns - 1)) < threshold
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(keep))

    return run


def toxic_free(docs: DataFrame, model: ToxicityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with all their columns."""
    modest_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("*", F.coalesce(F.col(text_col), F.lit("")).alias("__scored")).mapInArrow(_below(sent, threshold), docs.schema)
