"""Each operator on small tables, against plain Python."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, exact_dedup, linededup, minhash, mixing, pii, quality, sharding, toxicity, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """(doc_id, text, source) rows with the other columns, and some whose names clash with the operators' own."""
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    return spark.createDataFrame(full, DOC).withColumns({"id": F.lit("x"), "n": F.lit("y"), "size": F.lit("z"), "rank": F.lit(0), "bucket": F.lit(1)})


def awkward(spark):
    return docs(spark, [(1, None, "a"), (2, "", "a"), (3, "same text here now ok", None), (4, "same text here now ok", "b"), (4, "same text here now ok", "b"), (None, "no id at all but words", "b"), (7, "w " * 40_000, "a"), (8, "  \t\n", "c")])


def empty(spark):
    return docs(spark, [(1, "x", "a")]).where("false")


# 1


def saved(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return str(path)


def dedup_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, tmp_path, weak):
    rng = random.Random(3)
    rows = [(i, rng.choice(["", None, "a", "b", "cc", "dd" * 50]), "s") for i in range(200)] + [(500, "a", "s"), (500, "a", "s"), (None, "b", "s")]
    path = saved(docs(spark, rows).repartition(5), tmp_path / "t")
    digest = (lambda t: F.unhex(F.sha2(F.substring(t, 1, 1), 256))) if weak else exact_dedup.sha256
    got = exact_dedup.exact_dedup(spark, path, digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == dedup_by_hand([(i, t) for i, t, _ in rows])
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t, _ in rows})


def test_exact_dedup_goes_on_from_its_state(spark, tmp_path):
    path, mark = tmp_path / "t", str(tmp_path / "mark")
    saved(docs(spark, [(1, "a", "s"), (2, "b", "s")]), path)
    exact_dedup.exact_dedup(spark, str(path), checkpoint=mark).collect()
    docs(spark, [(3, "a", "s")]).write.mode("append").parquet(str(path))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(spark, str(path), checkpoint=mark).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True)}


def test_exact_dedup_in_small_batches(spark, tmp_path):
    path = saved(docs(spark, [(i, str(i % 3), "s") for i in range(30)]).repartition(6), tmp_path / "t")
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(spark, path, bytes_per_trigger=1).collect()}
    assert got == {i: 27 + i % 3 for i in range(30)}


def test_exact_dedup_awkward_and_empty(spark, tmp_path):
    got = exact_dedup.exact_dedup(spark, saved(awkward(spark), tmp_path / "a")).collect()
    assert len(got) == 8 and sum(r.kept for r in got) == 5
    assert exact_dedup.exact_dedup(spark, saved(empty(spark), tmp_path / "e")).collect() == []


# 2

ITEM = "the quick brown fox jumps over one lazy dog while seven small birds watch from an old stone wall near the river bank at dusk"


def test_decontaminate_finds_edited_copies(spark):
    rng = random.Random(5)
    noise = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    words = ITEM.split()
    swapped = [w if i % 7 else "changed" for i, w in enumerate(words)]
    dropped = [w for i, w in enumerate(words) if i % 9]
    rows = [(1, f"{noise(80)} {ITEM.upper()} {noise(30)}"), (2, f"{noise(5)}, {' '.join(swapped)}; {noise(500)}"), (3, " ".join(dropped)), (4, noise(400)), (5, noise(20) + " " + " ".join(words[:6]) + " " + noise(20)), (6, None), (7, "")]
    bench = spark.createDataFrame([(10, ITEM), (11, noise(30)), (12, "short"), (13, None)], "item_id long, text string")
    table = docs(spark, [(i, t, "s") for i, t in rows])
    got = {(r.doc_id, r.item_id): (r.score, r.start_word, r.end_word) for r in decontaminate.contamination(table, bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (3, 10)}
    assert got[(1, 10)] == (1.0, 80, 80 + len(words))
    assert sorted(r.doc_id for r in decontaminate.decontaminated(table, bench).collect()) == [4, 5, 6, 7]
    blocks = decontaminate.contamination(table, bench, block_bytes=1)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(got)


@pytest.mark.parametrize("beside", [False, True])
def test_decontaminate_finds_a_copy_that_lost_most_of_its_seeds(spark, beside):
    """Substitutions break 15 of 21 5-grams; an exact copy beside it makes those the rarer ones, its absence makes them count 0."""
    words = ITEM.split()
    edited = ["changed" if i % 7 == 3 else w for i, w in enumerate(words)]
    rows = [(1, "some words before " + " ".join(edited) + " some words after", "s")] + [(2, ITEM, "s")] * beside
    bench = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert set(got) == ({1, 2} if beside else {1}) and 0.7 < got[1] < 0.8
    assert decontaminate.decontaminated(docs(spark, rows), bench).count() == 0


def edited(rng, words, kind, rate):
    """``words`` with a share of about ``rate`` substituted, left out, or met by an added word, evenly or at random."""
    out = []
    for i, w in enumerate(words):
        if (i % round(1 / rate) == 1) if kind[1] == "even" else rng.random() < rate:
            new = f"new{rng.randrange(10**6)}"
            out += {"change": [new], "leave": [], "add": [w, new]}[kind[0]]
        else:
            out.append(w)
    return out


def test_decontaminate_recall_by_edit_rate(spark):
    """Against aligning every item with every whole text: one edited copy of each item and no other copy in the table."""
    rng = random.Random(21)
    vocabulary = ["the", "of", "and", "to", "in"] * 40 + ["".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    kinds = [(k, how) for k in ("change", "leave", "add") for how in ("even", "random")]
    cases = [(kind, 1 / every) for kind in kinds for every in (3, 4, 5, 6, 8, 12) for _ in range(4)]
    items = [rng.choices(vocabulary, k=rng.randint(25, 70)) for _ in cases]
    bodies = [rng.choices(vocabulary, k=60) + edited(rng, w, *case) + rng.choices(vocabulary, k=60) for w, case in zip(items, cases, strict=True)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contamination(docs(spark, [(i, " ".join(b), "s") for i, b in enumerate(bodies)]), bench).collect()}
    hashed = lambda texts: [decontaminate.word_hashes(pa.array([" ".join(t)]), ascii_words_only=True)[0] for t in texts]
    want = {}
    for d, text in enumerate(hashed(bodies)):
        for i, item in enumerate(hashed(items)):
            score = decontaminate.align(item, text)[0] / (2 * len(item))
            if score >= 0.5:
                want[d, i] = score
    assert set(got) <= set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    by_rate = defaultdict(list)
    for (d, i), score in want.items():
        by_rate[cases[d]].append((score, (d, i) in got))
    close = [found for seen in by_rate.values() for score, found in seen if score >= 0.7]
    assert len(close) > 90 and sum(close) == len(close)
    loose = [found for seen in by_rate.values() for _, found in seen]
    assert sum(loose) >= 0.97 * len(loose)


def test_decontaminate_repetitive_texts(spark):
    """Seeds that an item repeats, at every place of a long text."""
    item = "a b c d " * 30
    rows = [(1, "a b c d " * 20_000, "s"), (2, "x " * 500 + "a b c d " * 28 + "y " * 500, "s"), (3, "a b c d " * 5 + "z " * 90, "s")]
    got = {r.doc_id: (round(r.score, 3), r.end_word - r.start_word) for r in decontaminate.contamination(docs(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {1: (1.0, 120), 2: (round(112 / 120, 3), 112)}


def test_alignment_equals_the_textbook_one():
    import numpy as np

    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        assert decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == max(map(max, h))


def test_decontaminate_awkward_and_empty(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "same text here now ok")], "item_id long, text string")
    got = decontaminate.contamination(awkward(spark), bench).collect()
    assert sorted(r.doc_id for r in got) == [3, 4, 4]
    assert decontaminate.contamination(empty(spark), bench).collect() == []
    assert decontaminate.contamination(awkward(spark), bench.where("false")).collect() == []
    assert decontaminate.decontaminated(awkward(spark), bench.where("false")).count() == 8


# 3 and 7


def labelled(spark, n=900):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("etaoinshr", k=rng.randint(2, 8)))
    rows, marks = [], []
    for i in range(n):
        good, toxic = i % 4 != 0, i % 5 == 0
        text = [word() + ("." if rng.random() < 0.1 else "") for _ in range(rng.randint(30, 120))]
        if not good:
            text = [w.upper() + "!!" for w in text]
        if toxic:
            for _ in range(4):
                text[rng.randrange(len(text))] = rng.choice(["vile", "vilest", "scummy"])
        rows.append((i, " ".join(text), "s"))
        marks.append((i, int(good), int(toxic)))
    return docs(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifiers_hold_on_the_held_out_third(spark, kind):
    table, labels = labelled(spark)
    fit, threshold = (quality.fit_quality, 0.5) if kind == "quality" else (toxicity.fit_toxicity, 0.7)
    model = fit(table, labels)
    got = quality.scored(table, model, threshold).join(labels, "doc_id").where("held_out").collect()
    assert 250 < len(got) < 350
    assert sum(r.predicted == r[kind] for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    # Labels of the held-out third change nothing.
    flipped = labels.withColumn(kind, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col(kind)).otherwise(F.col(kind)))
    again = quality.scored(table, fit(table, flipped), threshold)
    assert {r.doc_id: round(r.score, 9) for r in again.where("held_out").collect()} == {r.doc_id: round(r.score, 9) for r in got}


def test_quality_scores_equal_a_fit_row_by_row(spark):
    """Ridge by adding up one labelled row after another, isotonic levels by the max-min of means over all runs."""
    table, labels = labelled(spark)
    labels = labels.withColumn("quality", F.when(F.col("doc_id") % 7 == 3, 1 - F.col("quality")).otherwise(F.col("quality")))
    model = quality.fit_quality(table, labels, waves=32)
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    ids = sorted(i for i in marks if i in texts and zlib.crc32(str(i).encode()) % 3 != 1)
    part = {r.id: r.part for r in spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", "pmod(xxhash64(id, 11), 5) AS part").collect()}
    stats = {i: quality.statistics(pa.array([texts[i]]))[0] for i in texts}
    mean = np.mean([stats[i] for i in ids], axis=0)
    spread = np.sqrt(np.mean([(stats[i] - mean) ** 2 for i in ids], axis=0))
    spread = np.where(spread > 1e-9, spread, 1)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, spread, rtol=1e-5)

    def waves(i):
        z = np.clip((stats[i] - model.mean) / model.scale, -8, 8)
        return np.array([1.0, *(np.sqrt(2 / 32) * np.cos(sum(z * model.project[:, j]) + model.phase[j]) for j in range(32))])

    gram, moment = 1e-2 * np.eye(33), np.zeros(33)
    for i in ids:
        if part[i] > 0:
            x = waves(i)
            gram, moment = gram + np.outer(x, x), moment + x * marks[i]
    weights = np.linalg.solve(gram, moment)
    held = sorted((float(waves(i) @ weights), marks[i]) for i in ids if part[i] == 0)
    y = [t for _, t in held]
    level = [max(min(np.mean(y[j : k + 1]) for k in range(i, len(y))) for j in range(i + 1)) for i in range(len(y))]
    blocks = [[i for i in range(len(y)) if round(level[i], 12) == v] for v in sorted(set(np.round(level, 12).tolist()))]
    centres = [np.mean([held[i][0] for i in b]) for b in blocks]
    levels = [(sum(y[i] for i in b) + 0.5) / (len(b) + 1) for b in blocks]
    want = {i: float(np.clip(np.interp(waves(i) @ weights, centres, levels), 0, 1)) for i in texts}
    got = {r.doc_id: r.score for r in quality.scored(table, model, 0.5).collect()}
    assert len(held) > 10 and len(blocks) > 1 and set(got) == set(want)
    assert max(abs(got[i] - want[i]) for i in want) < 1e-6


@pytest.mark.parametrize("fit", [quality.fit_quality, toxicity.fit_toxicity])
def test_classifiers_awkward_and_empty(spark, fit):
    label = "quality" if fit is quality.fit_quality else "toxic"
    table, labels = labelled(spark, 200)
    model = fit(table, labels)
    assert len(quality.scored(awkward(spark), model, 0.5).collect()) == 8
    assert quality.scored(empty(spark), model, 0.5).collect() == []
    for rows in (labels.where("false"), labels.where(f"{label} = 1"), labels.withColumn(label, F.lit(None).cast("int"))):
        got = quality.scored(table, fit(table, rows), 0.5).collect()
        assert len(got) == 200 and all(0 <= r.score <= 1 for r in got)


def test_counterfactuals_spare_neutral_mentions(spark):
    """Where a group is mostly named in toxic texts, the plain fit learns its name; the regularised one doesn't."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("etaoinshr", k=6))
    rows, marks = [], []
    for i in range(600):
        toxic = i % 3 == 0
        text = [word() for _ in range(30)]
        if toxic and rng.random() < 0.8:
            text[3] = "vile"
        if toxic and rng.random() < 0.7 or rng.random() < 0.02:
            text[7] = "muslims"
        elif rng.random() < 0.2:
            text[7] = "christians"
        rows.append((i, " ".join(text), "s"))
        marks.append((i, int(toxic)))
    table, labels = docs(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    neutral = pa.array([" ".join([word() for _ in range(29)] + ["muslims"]) for _ in range(50)])
    plain, fair = (toxicity.fit_toxicity(table, labels, fairness=f).scores(neutral).mean() for f in (0.0, 50.0))
    assert fair < 0.5 * plain
    assert toxicity.counterfactual("no group here") is None
    assert toxicity.counterfactual("The Muslims came") not in (None, "The Muslims came")


def test_twins_stay_in_their_language_and_number():
    for group in toxicity.IDENTITY_GROUPS:
        assert len(set(group)) == len(group) > 1
        for term in group:
            twin = toxicity.counterfactual(f"here come the {term} again")
            swapped = twin.removeprefix("here come the ").removesuffix(" again")
            assert swapped != term and swapped in toxicity.GROUP_OF[term]
    for i in range(200):
        none, one, other = toxicity.planted(f"First sentence number {i}. Then {i} comes another!\nAnd a last")
        a, b = (Counter(x.split()) - Counter(none.split()) for x in (one, other))
        assert len(a) == len(b) == 1 and a != b and next(iter(b)) in toxicity.GROUP_OF[next(iter(a))]
    assert toxicity.planted(" .\n!") is None and toxicity.planted("") is None


def test_penalty_acts_on_texts_that_name_no_group(spark):
    """The names' own weights are held near 0, and held-out accuracy stays, where labelled texts hold no name at all."""
    import numpy as np

    table, labels = labelled(spark)
    clean = table.join(labels.where("toxic = 0"), "doc_id")
    plain, fair = (toxicity.fit_toxicity(table, labels, fairness=f) for f in (0.0, 4.0))
    a, b = (np.abs(m.weights[np.isin(m.keys, toxicity.identity_keys())]).mean() for m in (plain, fair))
    assert b < 0.2 * a
    report = toxicity.mention_report(clean, fair).first()
    assert report.mentions == clean.count() and report.mean_gap_none < 0.01 and report.mean_gap_other < 0.01 and report.rejected_share == 0
    got = quality.scored(table, fair, 0.7).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.97


def test_penalised_loss_is_at_its_least():
    """No small step in any direction lowers the loss as written out row by row."""
    import math

    import numpy as np

    rng, keys, ridge, fairness = random.Random(3), 6, 0.5, 3.0

    def vector():
        cols = sorted(rng.sample(range(keys), rng.randint(1, 3)))
        return cols, [rng.uniform(0.1, 2) for _ in cols]

    rows = []
    for i in range(60):
        (c, v), (tc, tv) = vector(), vector()
        twin = i % 3 == 0
        y = None if i % 6 == 0 else float((0 in c) ^ (rng.random() < 0.2))
        rows.append({"y": y, "weight": 0.25 if i % 5 == 0 else 1.0, "cols": c, "vals": v, "twin_cols": tc if twin else None, "twin_vals": tv if twin else None})

    def loss(w, b):
        dot = lambda c, v: sum(w[k] * x for k, x in zip(c, v, strict=True))
        total = 0.5 * ridge * sum(x * x for x in w)
        for r in rows:
            own = dot(r["cols"], r["vals"])
            if r["y"] is not None:
                z = own + b
                total += r["weight"] * (math.log1p(math.exp(-abs(z))) + max(z, 0) - r["y"] * z)
            if r["twin_cols"] is not None:
                total += 0.5 * fairness * (own - dot(r["twin_cols"], r["twin_vals"])) ** 2
        return total

    w, b = toxicity._fit(rows, keys, ridge, fairness)
    least = loss(w, b)
    for k in range(keys + 1):
        for step in (1e-3, -1e-3):
            moved = np.append(w, b)
            moved[k] += step
            assert loss(moved[:-1], moved[-1]) > least


# 4


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", "d", None, "e"] + ["a"] * 6)) for i in range(400)] + [(1000, None, "a"), (1000, "x y", "zz")]
    got = mixing.mix(docs(spark, rows), [5, 2, 1], 3).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    cap, total, open_, target = {s: 3 * sizes[s] for s in order}, sum(sizes.values()), set(order), {}
    while True:
        left = total - sum(cap[s] for s in order if s not in open_)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap[s]}
        if not over:
            target = share | {s: cap[s] for s in order if s not in open_}
            break
        open_ -= over
    by_source = {i: s for i, _, s in rows[:-2]}
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        if r.doc_id in by_source:
            s = by_source[r.doc_id]
            assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6
            taken[s] += r.taken
    for s in order:
        assert s == "zz" or abs(taken[s] - target[s]) <= 1
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs(spark, rows).repartition(7), [5, 2, 1], 3).collect()), key=str)


def test_mixing_awkward_and_empty(spark):
    got = mixing.mix(awkward(spark), [5, 2, 1]).collect()
    assert len(got) == 8 and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(empty(spark), [5, 2, 1]).collect() == []


# 5


def test_warc_round_trip(spark):
    rng = random.Random(6)
    rows = [(i, f"http://x.org/{i}", rng.choice([None, "", "<p>é</p>", "<b>" + "z" * rng.randrange(5000), f"<i>{i}"])) for i in range(300)] + [(999, None, "<p>é</p>"), (1000, "http://x.org/a b\r\nWARC-Type: x", "<p>one of a kind")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("page", F.lit("clash"))
    got = {r.page_id: r for r in warc.warc_round_trip(spark, pages.repartition(5), archive_bytes=20_000).collect()}
    keep = {}
    for i, _, h in rows:
        keep[h or ""] = max(i, keep.get(h or "", -1))
    assert len(got) == len(rows)
    for i, _, h in rows:
        h = h or ""
        want = ("response", None) if keep[h] == i else ("revisit", keep[h])
        assert (got[i].record_type, got[i].refers_to) == want
        assert got[i].payload_bytes == len(h.encode()) and got[i].payload_digest == warc.digest(h.encode())
        assert bytes(got[i].payload) == (h.encode() if want[0] == "response" else b"")
    assert warc.warc_round_trip(spark, pages.where("false")).collect() == []


def test_warc_threshold_and_nulls(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb"), (None, "u", "bbbb"), (5, "u", "q"), (5, "u", "q")], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.warc_round_trip(spark, pages, least_bytes=3).collect()), key=str)
    assert got == sorted([(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None), (None, "revisit", 4), (5, "response", None), (5, "response", None)], key=str)


def archive(records):
    content = warc.dictionary(records)
    pressed = warc.zstd.ZstdCompressor(dict_data=warc.zstd.ZstdCompressionDict(content))
    return warc.opening(content) + b"".join(pressed.compress(r) for r in records)


def test_warc_of_a_very_long_page_and_a_bound_on_records(spark):
    page = "".join(random.Random(1).choices("abc<>é ", k=3_000_000))
    pages = spark.createDataFrame([(1, "u", page), (2, "u", "x" * 9_000_000), (3, "u", page)], "page_id long, url string, html string")
    for payloads in (True, False):
        got = {r.page_id: r for r in warc.warc_round_trip(spark, pages, payloads=payloads).collect()}
        assert [(got[i].record_type, got[i].refers_to, got[i].payload_bytes) for i in (1, 2, 3)] == [("revisit", 3, len(page.encode())), ("response", None, 9_000_000), ("response", None, len(page.encode()))]
        assert got[3].payload == (page.encode() if payloads else None)
    long = archive([warc.record(1, "http://x", b"y" * 100_000, None, False, "2024-01-01T00:00:00Z")])
    assert len(list(warc.read_archive(long))) == 1
    with pytest.raises(warc.WarcError, match="more than"):
        list(warc.read_archive(long, most=50_000))


def test_warc_refuses_what_is_broken():
    good = [warc.record(i, "http://x", b"body %d " % i * 20, None, False, "2024-01-01T00:00:00Z") for i in range(40)]
    whole = archive(good)
    assert [r.payload for r in warc.read_archive(whole)] == [b"body %d " % i * 20 for i in range(40)]
    broken = [
        whole[:4],
        whole[8:],
        whole[:-3],
        struct.pack("<II", warc.DICTIONARY_MAGIC, 10**6) + whole[8:],
        archive([g.replace(b"Content-Length: ", b"Content-Length: 9", 1) for g in good]),
        archive([g.replace(b"WARC-Date", b"X-Date") for g in good]),
        archive([g.replace(b"WARC/1.1", b"WARC/9.9") for g in good]),
        archive([g.replace(b"body", b"BODY") for g in good]),
        archive([g + g for g in good]),
    ]
    for data in broken:
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(data))


# 6

FIXED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def spans_by_hand(text):
    out = []
    for kind, p in FIXED.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            fine = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0, "phone": 9 <= len(d) <= 15}
            if fine[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(spark):
    rng = random.Random(8)
    alphabet = ["a@.b-", "1234567890 -.+()", "a1@. -+()9", "0123456789.", "é5-6@a.b+ "]
    texts = ["".join(rng.choices(rng.choice(alphabet), k=rng.randrange(120))) for _ in range(600)] + ["pay 4111 1111 1111 1111 or mail a.b@c.de, +1 (202) 555-0143 at 10.0.0.1", None, ""]
    got = pii.find_pii(docs(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert len(got) == len(texts)
    for r in got:
        want = spans_by_hand(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in FIXED]
        assert ",".join(s for s in r.spans.split(",") if s.split(":")[0] in FIXED) == ",".join(want)


def test_pii_weak_supervision_adds_and_weighs(spark):
    rows = []
    for i in range(300):
        rows.append((i, f"please email me: user{i}@mail{i % 7}.com or call +1 (202) 555-0{100 + i}", "s"))
        rows.append((1000 + i, f"order id {rng_digits(i)} version 1.2.3.{i} of the build", "s"))
    rows.append((5000, "write to me by email at jane.doe (at) site (dot) org or phone 020 7946 0958", "s"))
    table = docs(spark, rows)
    got = {r.doc_id: r.spans for r in pii.find_pii(table).collect()}
    assert "email_spelled" in got[5000]
    assert all(got[i].startswith("email:") and "phone:" in got[i] for i in range(300))
    proposed = table.select(F.col("doc_id").alias("doc"), "text").mapInArrow(pii._propose, pii.CANDIDATES)
    model = pii.fit_pii(proposed)
    assert model.reliability[0, 0] > 0.9  # the strict form of an address is nearly always right


def test_pii_precision_and_recall_on_planted_secrets_names_and_addresses(spark):
    rng = random.Random(31)
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    word = lambda: "".join(rng.choices("etaoinshr", k=rng.randint(2, 8)))
    first, last = ["Jane", "Peter", "Klaus", "María", "Sophie"], ["Miller", "Schmidt", "García", "Dupont", "O'Neil"]
    plant = {
        "secret": [lambda: ('token = "', hexed(40), '"'), lambda: ("api_key: ", "sk_" + hexed(12).upper() + hexed(12) + "9aZ", ""), lambda: ("password='", "hunter" + hexed(6), "'")],
        "person": [lambda: ("my name is ", f"{rng.choice(first)} {rng.choice(last)}", ","), lambda: ("Frau ", f"{rng.choice(first)} {rng.choice(last)}", " sagt")],
        "address": [lambda: ("I live at ", f"{rng.randint(1, 900)} {rng.choice(['Oak', 'Main', 'Mill'])} Street", ","), lambda: ("wohnt ", f"Linden{rng.choice(['straße', 'weg'])} {rng.randint(1, 99)}", ".")],
    }
    decoys = [lambda: f"commit: {hexed(40)}", lambda: "version 1.2.3", lambda: "color: red-orange", lambda: f"sha = {hexed(32)}", lambda: "Chapter 5 Of The Book", lambda: "path=/usr/local/lib/tool", lambda: f"isbn: 978{rng.randrange(10**10):010}"]
    rows, want = [], set()
    for i in range(600):
        text = " ".join(word() for _ in range(20)) + " "
        if i % 2:
            kind = rng.choice(list(plant))
            before, value, after = rng.choice(plant[kind])()
            want.add((i, kind, len(text) + len(before), len(text) + len(before) + len(value)))
            text += before + value + after
        else:
            text += rng.choice(decoys)()
        rows.append((i, text + " " + " ".join(word() for _ in range(20)), "s"))
    got = set()
    for r in pii.find_pii(docs(spark, rows)).collect():
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert r.n_spans == len(spans)
        got |= {(r.doc_id, k, int(a), int(b)) for k, a, b in spans if k in plant}
    for kind in plant:
        mine, theirs = {x for x in got if x[1] == kind}, {x for x in want if x[1] == kind}
        assert len(mine & theirs) >= 0.9 * len(theirs) and len(mine & theirs) >= 0.9 * len(mine), kind


def test_em_equals_the_plain_one():
    """Row by row and loop by loop, with the same start and pseudo-votes."""
    import math

    import numpy as np

    rng = np.random.default_rng(5)
    truth = rng.random(400) < 0.6
    right = [0.95, 0.8, 0.7, 0.6]
    cast = [[0 if rng.random() < 0.1 else (1 if t == (rng.random() < q) else -1) for q in right] for t in truth]
    counts = np.zeros(81)
    for c in cast:
        counts[sum((v + 1) * 3**i for i, v in enumerate(c))] += 1
    every = [[p // 3**i % 3 - 1 for i in range(4)] for p in range(81)]
    start = {tuple(c): 1 / (1 + math.exp(-2 * sum(c))) for c in every}
    pseudo = {s: [[4 * sum((start[tuple(c)] if s else 1 - start[tuple(c)]) for c in every if c[k] == v) / sum((start[tuple(c)] if s else 1 - start[tuple(c)]) for c in every) + 0.1 for v in (-1, 0, 1)] for k in range(4)] for s in (0, 1)}
    post = dict(start)
    for _ in range(60):
        share = (sum(post[tuple(c)] for c in cast) + 1) / (len(cast) + 2)
        table = {}
        for s in (0, 1):
            table[s] = [[sum((post[tuple(c)] if s else 1 - post[tuple(c)]) for c in cast if c[k] == v) + pseudo[s][k][v + 1] for v in (-1, 0, 1)] for k in range(4)]
            table[s] = [[x / sum(t) for x in t] for t in table[s]]
        for c in every:
            odds = math.log(share / (1 - share)) + sum(math.log(table[1][k][v + 1] / table[0][k][v + 1]) for k, v in enumerate(c))
            post[tuple(c)] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
    got, reliability = pii.expectation_maximisation(counts)
    assert np.allclose(got, [post[tuple(c)] for c in every], atol=1e-6)
    assert np.allclose(reliability, right, atol=0.08)


def rng_digits(i):
    return "".join(random.Random(i).choices("0123456789", k=16))


def test_pii_awkward_and_empty(spark):
    assert len(pii.find_pii(awkward(spark)).collect()) == 8
    assert pii.find_pii(empty(spark)).collect() == []


# 8


def packed_by_hand(sizes, capacity):
    """Best-fit-decreasing item by item: how many items of each size each bin has."""
    left, found = [], Counter()
    for size in sorted(sizes, reverse=True):
        fits = [(r, b) for b, r in enumerate(left) if r >= size]
        if not fits:
            fits = [(capacity, len(left))]
            left.append(capacity)
        left[min(fits)[1]] -= size
        found[size, min(fits)[1]] += 1
    return found, len(left)


def test_packing_equals_best_fit_item_by_item():
    rng = random.Random(7)
    for _ in range(200):
        sizes = [rng.randint(1, rng.choice([3, 10, 50])) for _ in range(rng.randint(1, 80))]
        histogram = list(Counter(sizes).items())
        filled = sharding.best_fit_decreasing(histogram, 60)
        want, bins = packed_by_hand(sizes, 60)
        got = Counter()
        for size, b, n in filled:
            got[size, b] += n
        assert got == want
        assert bins <= 11 / 9 * -(-sum(sizes) // 60) + 4
        assert sharding.best_fit_decreasing(histogram, 60, bins) == filled and sharding.best_fit_decreasing(histogram, 60, bins - 1) is None
    assert sharding.best_fit_decreasing([(9, 1)], 5) is None


def loads_by_hand(groups, shards):
    """Bytes of each shard at the smallest capacity that holds; as best fit isn't monotone, no capacity below one that failed is tried."""
    low = high = max(max(groups), -(-sum(groups) // shards))
    step = 1
    fits = lambda c: packed_by_hand(groups, c)[1] <= shards
    while not fits(high):
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        low, high = (low, (low + high) // 2) if fits((low + high) // 2) else ((low + high) // 2 + 1, high)
    load = Counter()
    for (size, b), n in packed_by_hand(groups, high)[0].items():
        load[b] += size * n
    return load


@pytest.mark.parametrize("most", [300, 6])
def test_sharding(spark, most):
    """Each shard's bytes are those of packing the groups one by one."""
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab é", k=rng.randrange(most))) for _ in range(500)]
    rows = [(i, rng.choice(texts + [None, ""] * 20), "s") for i in range(1500)]
    got = sharding.shard(docs(spark, rows), 16).collect()
    assert sorted(r.doc_id for r in got) == list(range(1500))
    by_text, load, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in got:
        by_text[rows[r.doc_id][1] or ""].add(r.shard)
        assert r["size"] == len((rows[r.doc_id][1] or "").encode()) + 1
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    groups = Counter()
    for _, t, _ in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    assert load == loads_by_hand(list(groups.values()), 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shard(docs(spark, rows).repartition(7), 16).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_sharding_awkward_and_empty(spark):
    assert sorted(r.slot for r in sharding.shard(awkward(spark), 1).collect()) == list(range(8))
    assert sharding.shard(empty(spark)).collect() == []


# 9


def near_by_hand(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("n", [2, 5])
def test_near_dedup(spark, n):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdef", k=4))
    rows = []
    for g in range(40):
        base = [word() for _ in range(rng.choice([1, 2, 3, 6, 12, 40, 150]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 15))):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), rng.choice([" ", "\n", " \t "]).join(copy).upper() if g % 2 else " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, " \n ")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_dedup(docs(spark, [(i, t, "s") for i, t in rows]), shingle_words=n).collect()}
    assert got == near_by_hand(rows, n, 80)


def test_near_dedup_links_leaves_through_their_centre(spark):
    """Copies that are each near the first but not near one another: a star that any other hub misses."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base = [word() for _ in range(300)]
    rows = [(50, " ".join(base))]
    for i in range(40):
        copy = list(base)
        for k in rng.sample(range(300), 16):
            copy[k] = word()
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_dedup(docs(spark, [(i, t, "s") for i, t in rows]), shingle_words=2).collect()}
    assert got == near_by_hand(rows, 2, 80)


def bucket_of(rng, low, size, linked):
    """Texts that share one bucket by their lowest word ``low``; only the given pairs of members are similar."""
    word = lambda: "".join(rng.choices("etaoinshr", k=12))
    bodies = [[word() for _ in range(20)] for _ in range(size)]
    for a, b in linked:
        bodies[b] = [*bodies[a][:19], word()]
    return [" ".join([low, *b]) for b in bodies]


def lowest_words(rng, n):
    """Words whose hashes come before practically every other word's."""
    words = ["".join(rng.choices("etaoinshr", k=6)) for _ in range(60_000)]
    return sorted(set(words), key=lambda w: int(minhash.shingle_set(minhash.word_hashes(pa.array([w]))[0], 1)[0]))[:n]


def missed_links(spark, groups):
    """Links not found among groups of (texts, linked pairs), each group one bucket, at random ids."""
    ids = random.Random(12).sample(range(10**6), sum(len(texts) for texts, _ in groups))
    rows, want = [], []
    for texts, linked in groups:
        own = [ids.pop() for _ in texts]
        rows += zip(own, texts, ["s"] * len(own), strict=True)
        want += [(own[a], own[b]) for a, b in linked]
    found = {r.doc_id: r.component_id for r in minhash.near_dedup(docs(spark, rows), shingle_words=1, bands=1, rows=1).collect()}
    assert len(set(found.values())) >= len(rows) - len(want)
    return [(a, b) for a, b in want if found[a] != found[b]]


def test_minhash_finds_links_in_a_large_bucket_whose_members_are_unlike_the_hubs(spark):
    rng = random.Random(11)
    pairs = [(k, k + 1) for k in range(0, 100, 2)]
    assert missed_links(spark, [(bucket_of(rng, w, 100, pairs), pairs) for w in lowest_words(rng, 2)]) == []


@pytest.mark.parametrize("size", [3, 4])
def test_minhash_finds_the_only_link_of_a_small_bucket_that_avoids_the_first_hub(spark, size):
    rng = random.Random(13)
    link = [(size - 2, size - 1)]
    assert missed_links(spark, [(bucket_of(rng, w, size, link), link) for w in lowest_words(rng, 40)]) == []


def test_near_dedup_of_an_id_with_several_texts(spark):
    """One id stands for unlike texts, each with a near copy of its own, and for a null beside another id's."""
    rng = random.Random(14)
    bodies = [["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)] for _ in range(4)]
    near = lambda body: " ".join([*body[:-1], "other"])
    a, b, c, d = bodies
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, None), (2, near(a)), (3, near(b)), (4, " ".join(c)), (4, ""), (4, None), (5, " ".join(d)), (5, ""), (6, near(c)), (7, near(d))]
    for table in (docs(spark, [(i, t, "s") for i, t in rows]), docs(spark, [(i, t, "s") for i, t in rows[::-1]]).repartition(5)):
        got = {(r.doc_id, r.component_id) for r in minhash.near_dedup(table, shingle_words=2).collect()}
        assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (6, 4), (5, 5), (7, 5)}


def test_near_dedup_awkward_and_empty(spark):
    got = minhash.near_dedup(awkward(spark), shingle_words=2).collect()
    assert len(got) == 8
    assert {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id in (3, 4, None)} == {(3, 3, True), (4, 3, False), (None, None, True)}
    assert minhash.near_dedup(empty(spark)).collect() == []


# 10


def units_by_hand(rows, least):
    """(removed spans, texts that are left)."""
    first, want, cut = {}, set(), {}
    for i, t in sorted(rows):
        at, number, seen = 0, 0, []
        for m in re.findall(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", t or ""):
            words = m.lower().split()
            if words:
                holder = first.setdefault(" ".join(words), (i, number))
                seen.append((number, at, at + len(m), len(words), None if holder == (i, number) else holder))
                number += 1
            at += len(m)
        runs, run = [], []
        for u in [*seen, (0, 0, 0, 0, None)]:
            if u[4] is not None:
                run.append(u)
            else:
                runs.append(run)
                run = []
        gone = []
        for run in runs:
            if sum(u[3] for u in run) >= least:
                want |= {(i, k, a, b, *kept) for k, a, b, _, kept in run}
                gone += [(a, b) for _, a, b, _, _ in run]
        out = list(t or "")
        for a, b in gone:
            out[a:b] = [""] * (b - a)
        cut[i] = "".join(out) if t is not None else None
    return want, cut


@pytest.mark.parametrize("least", [1, 8, 15])
def test_repeated_units(spark, least):
    rng = random.Random(13)
    pool = [" ".join(rng.choices("un deux Trois quatre cinq six é".split(), k=rng.randint(1, 7))) + rng.choice([".", "!", "?", "\n", "...\n\n"]) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(60)] + [(90, None), (91, " . \n ?")]
    want, cut = units_by_hand(rows, least)
    table = docs(spark, [(i, t, "s") for i, t in rows])
    got = {(r.doc_id, r.unit, r.start, r.end, r.kept_in, r.kept_unit) for r in linededup.repeated_units(table, least_words=least).collect()}
    assert want and got == want
    assert {r.doc_id: r.text for r in linededup.dedup_units(table, least_words=least).collect()} == cut


def test_repeated_units_finds_a_passage_inside_a_line_and_leaves_short_lines(spark):
    passage = "A shared passage begins here. It goes on for a while with words. Then it comes to its end, at last."
    rows = [(1, f"Menu\nfirst text and {passage} and so on."), (2, f"Menu\nsecond, quite other, {passage} with more."), (3, "Menu\nclean text.")]
    got = linededup.dedup_units(docs(spark, [(i, t, "s") for i, t in rows])).collect()
    assert {r.doc_id: r.text for r in got} == {1: rows[0][1], 2: "Menu\nsecond, quite other, A shared passage begins here. with more.", 3: rows[2][1]}


def test_repeated_units_of_repeated_and_equal_ranks(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen."
    rows = [(1, long), (1, long), (1, "other words. " + long), (2, long), (2, long), (None, long), (None, None)]
    got = Counter((r.doc_id, r.unit, r.kept_in, r.kept_unit) for r in linededup.repeated_units(docs(spark, [(i, t, "s") for i, t in rows])).collect())
    assert got == {(1, 0, None, 0): 2, (1, 1, None, 0): 1, (2, 0, None, 0): 2}


def test_repeated_units_awkward_and_empty(spark):
    got = linededup.repeated_units(awkward(spark), least_words=1).collect()
    assert {(r.doc_id, r.kept_in) for r in got} == {(4, 3)}
    assert linededup.repeated_units(awkward(spark)).collect() == []
    assert {r.doc_id: r.text for r in linededup.dedup_units(awkward(spark), least_words=1).collect()} == {r.doc_id: "" if r.doc_id == 4 else r.text for r in awkward(spark).collect()}
    assert linededup.repeated_units(empty(spark)).collect() == []
