"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (email, ip, card, phone) follow fixed patterns with checks and always
stay. Looser patterns propose further candidates, each of a kind of its own:
spelled-out addresses (email_spelled), local phone numbers (phone_local), IPv6
(ip6), account numbers (iban), assigned or bare credentials (secret), names of
persons (person) and street addresses (address). Base matches, also those that
fail their check, are candidates too.

Four labelers vote +1, -1 or abstain on each candidate: the strict form or
checksum (regex), lists of top-level domains, calling codes, issuers, names of
credentials, first names and street types (gazetteer), words before it
(context), and its neighbours (edges). Candidates of the whole corpus are counted
by family and votes, at most 7 * 3**4 rows; expectation-maximisation on these
counts estimates each labeler's reliability in each family and a posterior for
each voting pattern. A logistic classifier over span features is fitted to the
posteriors of a bounded sample of candidates, and keeps the looser candidates
that it gives at least ``threshold``.

Defined results: null text is empty and has no spans; very long texts are
searched whole; repeated rows are found alike; spans of different kinds may
overlap, except that a looser candidate which touches a base span is dropped, and
of looser ones that touch, the first kind as listed stays; an empty table gives an
empty result; only the two named columns are read, whatever the others' names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import modest_batches, stored

BASE = ("email", "ip", "card", "phone")
MORE = ("email_spelled", "ip6", "iban", "phone_local", "secret", "person", "address")
KINDS = BASE + MORE
#: Kinds whose labelers are weighed together.
FAMILIES = ("email", "ip", "card", "phone", "secret", "person", "address")
FAMILY = {k: i for i, k in enumerate(BASE)} | {"email_spelled": 0, "ip6": 1, "iban": 2, "phone_local": 3, "secret": 4, "person": 5, "address": 6}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SPELLED = re.compile(r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}){1,4}", re.IGNORECASE)
IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")
LOCAL_PHONE = re.compile(r"(?<![\w+.-])\(?0?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])")
ASSIGNED = re.compile(r"[=:] {0,2}[\"'`]?([A-Za-z0-9_+/=.~-]{8,256})")
BARE = re.compile(r"(?<![A-Za-z0-9_/+.=-])[A-Za-z0-9_-]{24,256}(?![A-Za-z0-9_/+.=-])")
KEY_NAME = re.compile(r"([A-Za-z][A-Za-z0-9_ -]{0,39}?)[\"'`]? {0,2}$")
CAPITAL = r"[A-ZÀ-ÖØ-Þ][\w'-]{1,30}"
PERSON = re.compile(rf"(?:Mrs?|Ms|Miss|Dr|Prof|Herrn?|Frau|Mme|Mlle|Sra?|[Nn]ame is|[Nn]amed|[Cc]alled|[Hh]eiße|m'appelle|[Ll]lamo|[Ss]igned by|[Cc]ontact)[.:]? (?:(?:Mrs?|Ms|Dr|Prof)\.? )?({CAPITAL}(?: (?:van |von |de |del |la )?{CAPITAL}){{0,2}})")
ADDRESS = re.compile(r"[0-9]{1,5}[A-Za-z]?,? (?:(?:[A-Z][\w'-]{1,30} ){1,3}[A-Z][a-z]{1,9}\b|(?:rue|avenue|boulevard|place|chemin) (?:de |du |des |la |l')*[A-ZÀ-Þ][\w'-]{1,30})|[A-ZÄÖÜ][\wäöüß-]{1,30}(?:straße|strasse|weg|platz|allee|gasse) [0-9]{1,4}[a-z]?\b|(?:Calle|Avenida|Plaza) (?:de |del |la )*[A-ZÁÉÍÓÚÑ][\w'-]{1,30},? [0-9]{1,4}\b")

# Fixed lists of the gazetteer and context labelers.
DOMAINS = frozenset("com org net edu gov mil int info biz name pro io co me tv app dev eu uk de fr es it nl be ch at pl pt se no dk fi ie cz gr hu ro ru ua us ca mx br ar cl au nz jp cn kr in za example test".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 966 971 972".split())
CREDENTIALS = frozenset("token secret key apikey password passwd passphrase pwd auth authorization bearer credential credentials private signature webhook".split())
FIRST_NAMES = frozenset("james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah charles karen anna peter hans klaus ursula monika stefan jürgen sabine jean marie pierre michel claude sophie camille julien josé maría juan carmen antonio ana manuel laura jane alice bob emma olivia noah liam".split())
STREETS = frozenset("street st road rd avenue ave lane ln drive dr boulevard blvd court ct square sq way place pl terrace close rue chemin straße strasse weg platz allee gasse calle avenida plaza".split())
HINTS = {
    0: frozenset("email mail e-mail contact write reach correo courriel kontakt".split()),
    1: frozenset("ip address host server client from adresse".split()),
    2: frozenset("card visa mastercard amex credit debit payment karte carte tarjeta iban account konto".split()),
    3: frozenset("phone tel telephone call mobile fax cell telefon téléphone teléfono whatsapp".split()),
    4: frozenset("token secret key password login credentials auth bearer api private access".split()),
    5: frozenset("name mr mrs ms dr prof herr frau mme mlle sr sra signed dear heiße appelle llamo contact".split()),
    6: frozenset("address live lives living at located office street adresse wohne wohnt habite domicilio dirección vive".split()),
}
AGAINST = {f: frozenset("version v release build isbn issn doi order invoice ticket serial total token hash id".split()) for f in range(4)} | {
    4: frozenset("commit sha md5 checksum digest revision hash uuid version isbn doi etag path url".split()),
    5: frozenset("mount lake river street company inc museum".split()),
    6: frozenset("version chapter section page figure table season".split()),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local@domain, in linear time: from each at sign to both sides."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_candidates(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passes) of each match of the four fixed patterns."""
    for s, e in emails(text):
        yield "email", s, e, True
    for m in IP.finditer(text):
        # A part of any length is compared as a number without building one.
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    for m in CARD.finditer(text):
        n = m.end() - m.start()
        if n >= 13:
            d = digits_of(m[0])
            yield "card", m.start(), m.end(), 13 <= len(d) <= 19 and luhn(d)
    for m in PHONE.finditer(text):
        yield "phone", m.start(), m.end(), 9 <= len(digits_of(m[0])) <= 15


def iban_holds(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def more_candidates(text: str, base: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """Looser candidates that touch no base span and no looser one before them."""
    taken = sorted(base)
    starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))

    def free(start: int, end: int) -> bool:
        at = bisect_left(starts, end)
        return not at or reach[at - 1] <= start

    for kind, patterns in (("email_spelled", (SPELLED,)), ("ip6", (IP6,)), ("iban", (IBAN,)), ("phone_local", (LOCAL_PHONE,)), ("secret", (ASSIGNED, BARE)), ("person", (PERSON,)), ("address", (ADDRESS,))):
        found = []
        for pattern in patterns:
            for m in pattern.finditer(text):
                start, end = m.span(1) if pattern.groups and kind in ("secret", "person") else m.span()
                end -= len(text[start:end]) - len(text[start:end].rstrip(" .-=")) if kind in ("secret", "person") else 0
                if start < end and free(start, end) and (kind != "secret" or end - start >= 8):
                    found.append((start, end))
        if found:
            kept, last = [], 0
            for start, end in sorted(set(found)):
                if start >= last:
                    kept.append((start, end))
                    last = end
            yield from ((kind, *span) for span in kept)
            taken = sorted([*taken, *kept])
            starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))


def random_looking(span: str) -> bool:
    """Long hexadecimal, or long with digits among letters of both cases: hardly a word."""
    if len(span) >= 24 and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", span):
        return any(c.isdigit() for c in span) and any(c.isalpha() for c in span)
    return len(span) >= 16 and sum(c.isdigit() for c in span) >= 3 and any(c.islower() for c in span) and any(c.isupper() for c in span)


def key_words(text: str, start: int) -> list[str]:
    """The words of the name that the value at ``start`` is assigned to; none where nothing is assigned."""
    before = text[max(0, start - 48) : start].rstrip("\"'`").rstrip(" ")
    if before[-1:] not in ("=", ":"):
        return []
    m = KEY_NAME.search(before[:-1])
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1]).lower())[-3:] if m else []


def votes(kind: str, text: str, start: int, end: int, passes: bool) -> tuple[int, int, int, int]:
    """regex, gazetteer, context and edges: 1 for, -1 against, 0 abstains."""
    span, family = text[start:end], FAMILY[kind]
    d = digits_of(span)
    strict = passes
    if kind == "iban":
        strict = iban_holds(span)
    elif kind == "phone_local":
        strict = 9 <= len(d) <= 12
    elif kind == "email_spelled":
        strict = "at)" in span.lower() or "at]" in span.lower()
    elif kind == "secret":
        strict = random_looking(span)
    elif kind == "person":
        strict = len(span.split()) >= 2
    elif kind == "address":
        strict = bool(re.match(r",? *(?:[A-Z][\w-]+ *,? *)?[0-9]{4,5}\b", text[end : end + 40])) or span[:1].isdigit() or span[-1:].isdigit()
    named = re.findall(r"[^\W\d_]+", span.lower())
    if family == 0:
        listed = 1 if re.split(r"[^A-Za-z]+", span.lower())[-1] in DOMAINS else -1
    elif family == 1:
        listed = 0 if kind == "ip6" else (1 if 0 < int(span.split(".")[0][:4] or 0) < 224 else -1)
    elif family == 2:
        listed = (0 if kind == "iban" else 1 if d[:1] in "3456" or 2221 <= int(d[:4]) <= 2720 else -1) if d else -1
    elif family == 3:
        listed = (1 if any(d[:n] in CALLING_CODES for n in (1, 2, 3)) else -1) if kind == "phone" else (1 if d[:1] == "0" or "(" in span else 0)
    elif family == 4:
        key = key_words(text, start)
        listed = 1 if any(w in CREDENTIALS for w in key) and not any(w in AGAINST[4] for w in key) else -1 if key else 0
    elif family == 5:
        listed = 1 if named and named[0] in FIRST_NAMES else 0
    else:
        listed = 1 if any(w in STREETS for w in named) or re.search("(?:straße|strasse|weg|platz|allee|gasse)", span) else -1
    before = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", text[max(0, start - 40) : start].lower())[-4:]
    context = -1 if any(w in AGAINST[family] for w in before[-2:]) else 1 if any(w in HINTS[family] for w in before) else 0
    left, right = text[max(0, start - 1) : start], text[end : end + 1]
    edges = -1 if left.isalnum() or right.isalnum() or left in "=#$€" and left and family != 4 else 1
    return (1 if strict else -1), listed, context, edges


FEATURES = 256


def span_features(kind: str, text: str, start: int, end: int, cast: tuple[int, ...]) -> list[int]:
    """Hashed one-hot features: votes by family, shape, and the word before."""
    family, span = FAMILY[kind], text[start:end]
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", span))[:24]
    before = text[max(0, start - 24) : start].lower().split()[-1:]
    named = [f"{family}:v{i}:{v}" for i, v in enumerate(cast)] + [f"{family}:shape:{shape}", f"{family}:n:{min(6, (end - start) // 4)}", f"w:{before}"]
    return sorted({crc32(x.encode()) % FEATURES for x in named})


CANDIDATES = "doc long, kind array<int>, start array<int>, end array<int>, stays array<boolean>, pattern array<int>, features array<array<int>>"


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[], [], [], [], [], []]
        for value in batch.column(1):
            text = value.as_py() or ""
            found = [(k, s, e, ok, ok) for k, s, e, ok in base_candidates(text)]
            found += [(k, s, e, True, False) for k, s, e in more_candidates(text, [(s, e) for _, s, e, ok, _ in found if ok])]
            cast = [votes(k, text, s, e, ok) for k, s, e, ok, _ in found]
            out[0].append([KINDS.index(k) for k, *_ in found])
            out[1].append([s for _, s, *_ in found])
            out[2].append([e for _, _, e, *_ in found])
            out[3].append([stays for *_, stays in found])
            out[4].append([sum((v + 1) * 3**i for i, v in enumerate(c)) for c in cast])
            out[5].append([span_features(k, text, s, e, c) for (k, s, e, _, _), c in zip(found, cast, strict=True)])
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.list_(k)) for c, k in zip(out, kinds, strict=True))], names=["doc", "kind", "start", "end", "stays", "pattern", "features"])


@dataclass
class PiiModel:
    posterior: np.ndarray  # family x pattern
    reliability: np.ndarray  # family x labeler: share of its votes that agree with the posterior
    weights: np.ndarray
    bias: float
    threshold: float

    def accepts(self, features: list[int]) -> bool:
        return 1 / (1 + np.exp(-(self.bias + self.weights[features].sum()))) >= self.threshold


def _cast(pattern: int) -> list[int]:
    return [pattern // 3**i % 3 - 1 for i in range(4)]


def expectation_maximisation(counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each voting pattern and reliability of each labeler, from how often each pattern was seen.

    Naive-Bayes mixture of two classes over the labelers' three outcomes, started from the majority's opinion.
    """
    cast = np.array([_cast(p) for p in range(81)])
    prior = 1 / (1 + np.exp(-2.0 * cast.sum(axis=1)))
    post = prior.copy()
    seen = np.eye(3)[cast + 1]  # pattern, labeler, outcome
    for _ in range(rounds):
        share = (counts @ post + 1) / (counts.sum() + 2)
        yes = np.einsum("p,plo->lo", counts * post, seen) + _smooth(prior, seen)
        no = np.einsum("p,plo->lo", counts * (1 - post), seen) + _smooth(1 - prior, seen)
        yes, no = yes / yes.sum(1, keepdims=True), no / no.sum(1, keepdims=True)
        odds = np.log(share / (1 - share)) + np.einsum("plo,lo->p", seen, np.log(yes) - np.log(no))
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    agree = np.where(cast > 0, post[:, None], 1 - post[:, None]) * (cast != 0)
    voted = (counts[:, None] * (cast != 0)).sum(0)
    return post, np.where(voted > 0, (counts[:, None] * agree).sum(0) / np.maximum(voted, 1), 0.5)


def _smooth(belief: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """A few pseudo-votes in which labelers lean the majority's way, so that no class can swap sides."""
    return 4 * np.einsum("p,plo->lo", belief, seen) / belief.sum() + 0.1


def fit_pii(candidates: DataFrame, train_spans: int = 20_000, ridge: float = 1.0, threshold: float = 0.5) -> PiiModel:
    """Reliabilities from the counts of all candidates; the classifier from about ``train_spans`` of them at most."""
    one = candidates.select("doc", F.explode(F.arrays_zip("kind", "pattern", "features", "start")).alias("c")).select("doc", "c.*")
    family = [FAMILY[k] for k in KINDS]
    counts = np.zeros((len(FAMILIES), 81))
    for r in one.groupBy("kind", "pattern").count().collect():
        counts[family[r["kind"]], r["pattern"]] += r["count"]
    found = [expectation_maximisation(c) for c in counts]
    posterior = np.array([p for p, _ in found])
    share, grains = min(1.0, train_spans / max(1.0, counts.sum())), 1 << 30
    rows = one.where(F.pmod(F.xxhash64("doc", "start", "kind"), F.lit(grains)) < int(share * grains)).select("kind", "pattern", "features").collect()
    if not rows:
        return PiiModel(posterior, np.array([r for _, r in found]), np.zeros(FEATURES), 0.0, threshold)
    y = np.array([posterior[family[r["kind"]], r["pattern"]] for r in rows])
    x = np.zeros((len(rows), FEATURES))
    for i, r in enumerate(rows):
        x[i, r["features"]] = 1
    w = np.zeros(FEATURES + 1)
    full = np.column_stack([x, np.ones(len(x))])
    for _ in range(12):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (p - y) + ridge * w
        curve = (full * (p * (1 - p))[:, None]).T @ full + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return PiiModel(posterior, np.array([r for _, r in found]), w[:-1], float(w[-1]), threshold)


def _decide(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[1:]]
            counts, shas, spans, every = [], [], [], []
            for kind, start, end, stays, _, features in zip(*cols, strict=True):
                rows = sorted((k, s, e) for k, s, e, b, f in zip(kind, start, end, stays, features, strict=True) if b or k >= 4 and m.accepts(f))
                said = [f"{KINDS[k]}:{s}:{e}" for k, s, e in rows]
                own = sum(k < 4 for k, _, _ in rows)
                counts.append([sum(k == j for k, _, _ in rows) for j in range(4)])
                shas.append(hashlib.sha256(",".join(said[:own]).encode()).hexdigest())
                spans.append(",".join(said))
                every.append(len(said))
            by_kind = [pa.array([c[j] for c in counts], pa.int64()) for j in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *by_kind, pa.array(shas, pa.string()), pa.array(spans, pa.string()), pa.array(every, pa.int64())], names=["doc", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_spans"])

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_spans: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """Each row's id, count of each base kind, base_sha256, all spans as kind:start:end, and their number."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    candidates = stored(rows.mapInArrow(_propose, CANDIDATES), "pii-candidates")
    model = fit_pii(candidates, train_spans, threshold=threshold)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc long, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string, n_spans long"
    return candidates.mapInArrow(_decide(sent), schema).withColumnRenamed("doc", id_col)
