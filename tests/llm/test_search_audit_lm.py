"""Ranked search, the filter audit and the class language model against plain Python."""

import math
import random
import re
from collections import Counter
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import audit, classlm, search, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [(1, None, None), (2, "", "en"), (3, " \t\n", "en"), (None, "alpha beta", None), (5, "Alpha  BETA\x1cgamma", "de"), (5, "Alpha  BETA\x1cgamma", "de"), (6, "ÄÖ straße é", "de"), (7, "x" * 300_000, "en"), (8, "alpha " * 40_000, "en")]


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "of", "OF", "naïve", "#tag", "a|b"]
    return [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 160))), rng.choice(["en", "de", None, ""])) for i in range(n)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def table(spark, rows):
    # Extra columns carry names that the operators use themselves.
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, term string, shard int")


def test_codes_give_the_words_back():
    texts = [t for _, t, _ in [*EDGES, *corpus(10)]]
    of, codes, words = tokens.coded(pa.array(texts), tokens.byte_map(False))
    got = [(i, w) for i, w in zip(of.tolist(), words.take(pa.array(codes)).to_pylist(), strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(lower(t or ""))]
    values = np.array([0, 1, 127, 128, 300, 2**31, 2**62])
    assert tokens.unvarint(tokens.varint(values)[0].tobytes()).tolist() == values.tolist()


def test_shards_keep_all_rows():
    rows = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, "b" * 50, None, "", "c" * 5, "d" * 5])], names=["id", "text"])
    parts = list(tokens.shards([rows, rows], limit=16))
    assert [i for p in parts for i in p.column("id").to_pylist()] == [*range(6), *range(6)] and len(parts) > 3


def ranked_by_hand(docs, items, k):
    terms = re.compile(search.TERM)
    split = [(i, terms.findall(lower(t or ""))) for i, t, *_ in docs]
    split = [(i, t) for i, t in split if t]
    n_docs, total, df = len(split), sum(len(t) for _, t in split), Counter(x for _, t in split for x in set(t))
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms.findall(lower(text or "")))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc, own in split:
            tf, m = Counter(own), 50 + (50 * len(own) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in wanted if tf[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("shard_bytes", [1, 4000, 1 << 24])
def test_search_equals_scoring_everything(spark, shard_bytes):
    docs = EDGES + corpus() + [(900 + i, "w1 w2 w3", "en") for i in range(70)]
    items = [(1, "w1 w2 THE naïve"), (1, "w3"), (2, None), (None, "w4 w5 w4 straße"), (3, "nowhere to be found"), (4, " ".join(f"w{i}" for i in range(60)))]
    found = search.search(search.build_index(table(spark, docs), shard_bytes=shard_bytes), spark.createDataFrame(items, "item_id long, text string"), 50)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == ranked_by_hand(docs, items, 50)


def test_search_in_blocks_of_items_and_with_text_ids(spark, monkeypatch):
    docs, items = corpus(60), [(f"q{i}", f"w{i} w{i + 1} of") for i in range(12)]
    monkeypatch.setattr(search, "BLOCK_TERMS", 5)
    named = spark.createDataFrame([(f"d{i}", t) for i, t, _ in docs], "doc_id string, text string")
    found = search.ranked_search(named, spark.createDataFrame(items, "item_id string, text string"), 7)
    assert Counter(map(tuple, found.collect())) == ranked_by_hand([(f"d{i}", t) for i, t, _ in docs], items, 7)


def test_search_of_nothing(spark):
    none, some = table(spark, []), spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert search.ranked_search(none, some).count() == 0
    assert search.ranked_search(table(spark, corpus(5)), some.limit(0)).count() == 0


def test_pruning_never_changes_the_best():
    rng = random.Random(5)
    for _ in range(60):
        lists = []
        for _ in range(rng.randint(1, 7)):
            at = sorted(rng.sample(range(80), rng.randint(1, 60)))
            adds = [rng.randint(0, 5) * rng.choice([1, 1, 20]) for _ in at]
            lists.append((at, adds, max(adds)))
        total = Counter()
        for at, adds, _ in lists:
            for d, a in zip(at, adds, strict=True):
                total[d] += a
        want = sorted(((-s, d) for d, s in total.items() if s > 0))[:5]
        assert sorted((-s, d) for s, d in search.top_of_shard(lists, 5)) == want


def audited_by_hand(docs, labels):
    first, known = {}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, q, x in labels:
        if i is not None:
            old = known.get(i, (0, 0))
            known[i] = (max(old[0], q or 0), max(old[1], x or 0))
    rows = {}
    for i, text, lang in docs:
        t = text or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        rows.setdefault(lang or "", []).append(({f for f, on in fails.items() if on}, *(v == 1 for v in known.get(i, (0, 0)))))
    out = {}
    for part, own in rows.items():
        every = {}
        for order in permutations("ABCDE"):
            gone = set()
            for step, f in enumerate(order, 1):
                hit = [r for r in own if f in r[0] and not r[0] & gone]
                late = [r for r in own if f in r[0] and r[0] & gone]
                gone = gone | {f}
                every[("".join(order), step)] = (sum(not r[0] & gone for r in own), len(hit), len(late), sum(r[0] == {f} for r in own), sum(r[1] for r in hit), sum(r[2] for r in hit), f)
        for (order, step), v in every.items():
            out[(part, order, step)] = (*v[:6], sum(x[1] for x in every.values() if x[6] == v[6]))
    return out


def test_audit_equals_every_order_by_hand(spark):
    docs = EDGES + corpus(200) + [(500 + i, "Same TEXT " * 60, "fr") for i in range(20)] + [(None, "Same TEXT " * 60, "fr")]
    labels = [(100 + i, i % 2, i % 3 == 0) for i in range(0, 150)] + [(500, 1, None), (500, 0, 1), (None, 1, 1), (9999, 1, 1)]
    labels = [(i, q, None if x is None else int(x)) for i, q, x in labels]
    found = audit.audit(table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()}
    assert got == audited_by_hand(docs, labels)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(table(spark, []), labels).count() == 0
    assert audit.audit(table(spark, corpus(3)), labels).agg({"good_lost": "max"}).first()[0] == 0


def test_a_move_changes_the_likelihood_as_said():
    rng = np.random.default_rng(0)
    n_wid, n_classes = 40, 6
    n_all = n_classes + classlm.SHAPES + 1
    codes = np.append(rng.integers(0, n_wid + classlm.SHAPES + 1, 3000), n_wid + classlm.SHAPES).astype(np.int32)
    classes = rng.integers(0, n_classes, n_wid).astype(np.int32)

    def counted(classes):
        t, c = np.zeros((n_wid, 2 * n_all + 1), np.int64), np.zeros((n_all, n_all), np.int64)
        classlm.add_neighbours(codes, classlm.with_fixed(classes, n_classes), t, c)
        return t, c

    t, c = counted(classes)
    assert c.sum() == len(codes)
    for w in range(0, n_wid, 5):
        gain = classlm.gains(t[w], int(classes[w]), c, n_classes)
        for to in range(n_classes):
            after = classes.copy()
            after[w] = to
            assert gain[to] == pytest.approx(classlm.likelihood(counted(after)[1]) - classlm.likelihood(c), abs=1e-6)


def sentences(n=300, seed=11):
    """Two alternating kinds of words, so that classes predict and single words don't."""
    rng = random.Random(seed)
    kinds = [[f"{k}{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(5)] for k in "ab"]
    return [(i, " ".join(rng.choice(kinds[j % 2]) for j in range(rng.randint(5, 40)))) for i in range(n)]


def test_scores_equal_the_model_written_out(spark):
    docs = [(i, t) for i, t, _ in EDGES] + sentences()
    rows = spark.createDataFrame([(*r, "y") for r in docs], "doc_id long, text string, word string")
    texts = classlm.encoded(rows, "doc_id", "text")
    vocab = classlm.vocabulary(texts)
    wid = {r.word: r.wid for r in vocab.words.where("wid is not null").collect()}
    classes, c = classlm.cluster(classlm.recoded(texts, vocab), vocab, 8, 4)
    held = lambda i: i is not None and crc32(str(i).encode()) % 5 == 1
    count = Counter(w for i, t in docs if not held(i) for w in [*WORD.findall(lower(t or "")), ""])
    n, v = sum(count.values()), len(count)
    assert (vocab.tokens, vocab.distinct) == (n, v) and [count[w] for w in sorted(wid, key=wid.get)] == vocab.clustered.tolist()
    shape = lambda w: int(classlm.word_shapes(pa.array([w]))[0])
    of = lambda w: 8 + classlm.SHAPES if w == "" else int(classes[wid[w]]) if w in wid else 8 + shape(w)
    pairs, size, kinds = Counter(), Counter(), Counter()
    for i, t in docs:
        if not held(i):
            at = 8 + classlm.SHAPES
            for w in [*WORD.findall(lower(t or "")), ""]:
                pairs[at, of(w)] += 1
                at = of(w)
    for w, k in count.items():
        size[of(w)] += k
        kinds[of(w)] += 1
    n_all = 8 + classlm.SHAPES + 1
    assert all(c[a, b] == pairs[a, b] for a in range(n_all) for b in range(n_all))
    live = [d for d in range(n_all) if d >= 8 or size[d]]
    prior = {d: sum(pairs[a, d] for a in range(n_all)) + 0.5 for d in live}
    whole = sum(prior.values())

    def p(a, w):
        d = of(w)
        step = (pairs[a, d] + classlm.KAPPA * prior[d] / whole) / (sum(pairs[a, x] for x in range(n_all)) + classlm.KAPPA)
        own = 1 if w == "" else count[w] / size[d] if w in wid else (count[w] + 0.5) / (size[d] + 0.5 * (kinds[d] + 1))
        return step * own

    # Over all that may come next, with one unknown word a shape, probabilities add up to one.
    unknown = sum((pairs[0, d] + classlm.KAPPA * prior[d] / whole) / (sum(pairs[0, x] for x in range(n_all)) + classlm.KAPPA) * 0.5 / (size[d] + 0.5 * (kinds[d] + 1)) for d in range(8, 8 + classlm.SHAPES))
    assert sum(p(0, w) for w in count) + unknown == pytest.approx(1)
    want = Counter()
    for i, t in docs:
        words = [*WORD.findall(lower(t or "")), ""]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        score, at = 0.0, 8 + classlm.SHAPES
        for w in words:
            score += math.log10(p(at, w))
            at = of(w)
        want[(i, held(i), len(words), sum(count[w] > 0 for w in words), n, f"{base:.6f}", f"{score:.6f}")] += 1
    got = classlm.lm_scores(rows, 8, 4).collect()
    assert Counter((*tuple(r)[:5], f"{r.base_score:.6f}", f"{r.score:.6f}") for r in got) == want
    out = [r for r in got if r.held_out and 5 < r.n_tokens < 100]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in got)


def test_classes_part_what_alternates(spark):
    rows = spark.createDataFrame(sentences(), "doc_id long, text string")
    texts = classlm.encoded(rows, "doc_id", "text")
    vocab = classlm.vocabulary(texts)
    classes, _ = classlm.cluster(classlm.recoded(texts, vocab), vocab, 2, 8)
    words = {r.word: classes[r.wid] for r in vocab.words.where("wid is not null").collect()}
    assert len({k for w, k in words.items() if w[0] == "a"}) == 1 and len(set(words.values())) == 2


def test_language_model_without_training_or_texts(spark):
    held = [i for i in range(60) if crc32(str(i).encode()) % 5 == 1]
    found = classlm.lm_scores(spark.createDataFrame([(i, "one two") for i in held], "doc_id long, text string")).collect()
    assert len(found) == len(held) and all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in found)
    assert classlm.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
