"""Personal data by weak supervision (operator 9).

Base patterns give spans that always stay.  Wider patterns give candidates of
the same kinds (written-out or masked forms).  Labelers vote on every
candidate: format, check digits and ranges, gazetteers (top-level domains,
country codes, card issuers), words around it, and signs against it.  Spark
counts the vote patterns of the whole corpus; expectation-maximisation over
these counts estimates how reliable each labeler is and how likely each
pattern is personal data, and a logistic span classifier is trained on the
result.  Candidates that it accepts and that touch no span before them are
added.

All offsets are code points, ends exclusive.  Null and empty texts have no
spans.  Every row is judged by itself, repeated rows alike.  An empty table
gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import arrow_map, keyed

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.5
EM_ROUNDS = 50
CONTEXT = 24                    # code points looked at on either side

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")
#: texts that can hold a span at all
MAY_HOLD = r"[0-9@]|(?i:[(\[{] ?at ?[)\]}])"

_WIDE = {
    "email": [re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[{] ?(?:at|@) ?[)\]}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[{] ?(?:dot|\.) ?[)\]}]) ?[A-Za-z0-9-]{2,24}){1,4}", re.I)],
    "ip": [re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?: ?[(\[{] ?(?:\.|dot) ?[)\]}] ?[0-9]{1,3}){3}(?![0-9A-Za-z])", re.I),
           re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")],
    "card": [re.compile(r"(?<![0-9A-Za-z])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9A-Za-z])"),
             re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])")],
    "phone": [re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])"),
              re.compile(r"(?<![0-9A-Za-z+.-])(?<![0-9] )(?:00[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z.-]| [0-9])")],
}
#: gazetteers and context words: fixed values
TLDS = frozenset("com org net edu gov mil int info biz io de fr es it uk nl eu us ca ch at be se no dk pl pt br ru cn jp in au".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                 "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "351", "352", "353", "358", "420")
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65")
WORDS_FOR = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|reach|address|correo|courriel|adresse)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|login|client|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:tel|phone|call|mobile|cell|fax|dial|whatsapp|telefon|tel[eé]fono|portable|anruf)\b", re.I),
}
WORDS_AGAINST = re.compile(r"\b(?:version|chapter|section|page|isbn|issn|sha|md5|hash|order|invoice|id|no|nr|serial|release|figure|table)\.?\s*[:#=]?\s*$", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += (v * 2 - 9 if v > 4 else v * 2) if k % 2 else v
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped.
    Each kind is found in time proportional to the text."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, end := m.end()))
        at = text.find("@", max(at + 1, end))
    for m in _CHAIN.finditer(text):
        parts = m.group().split(".")
        pos = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(map(_byte, four)):
                out.append(("ip", pos, pos + size))
            pos += size + 1
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.sub("", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, bool]]:
    """Base spans and wider matches that touch none of them."""
    taken = sorted((a, z) for _, a, z in base)
    out = [(k, a, z, True) for k, a, z in base]
    for kind in KINDS:
        for pattern in _WIDE[kind]:
            for m in pattern.finditer(text):
                a, z = m.span()
                if not any(x < z and a < y for x, y in taken):
                    out.append((kind, a, z, False))
    return out


def votes(text: str, kind: str, a: int, z: int, strict: bool) -> tuple[int, ...]:
    """1 for, -1 against, 0 no opinion: format, check, gazetteer, words
    before and after, signs against, edges."""
    body = text[a:z]
    digits = _DIGITS.sub("", body)
    if kind == "email":
        tld = re.sub(r"[^a-z]", "", re.split(r"[.)\]} ]", body.lower())[-1])
        check, listed = (1 if re.search(r"[A-Za-z]", body) else -1), (1 if tld in TLDS else -1 if not 2 <= len(tld) <= 6 else 0)
    elif kind == "ip":
        parts = re.findall(r"[0-9A-Fa-f]+", body)
        four = len(parts) == 4 and all(p.isdigit() and _byte(p) for p in parts)
        check = 1 if four or len(parts) == 8 else -1
        listed = 0 if not four else -1 if parts[0] in ("0", "255") else 1 if any(len(p) > 1 for p in parts) else 0
    elif kind == "card":
        check = 1 if luhn(digits) and 13 <= len(digits) <= 19 else -1
        listed = 1 if digits.startswith(ISSUERS) else -1 if digits[:1] in "089" else 0
    else:
        marked = "+" in body or "(" in body or digits.startswith("00") or not re.search(" ", body)     # three bare numbers are no phone
        check = 1 if 8 <= len(digits) <= 15 and marked else -1
        number = digits[2:] if digits.startswith("00") else digits
        listed = 1 if ("+" in body or digits.startswith("00")) and number.startswith(CALLING_CODES) else 0
    near = text[max(0, a - CONTEXT):a]
    around = 1 if WORDS_FOR[kind].search(near) or WORDS_FOR[kind].search(text[z:z + CONTEXT]) else 0
    against = -1 if WORDS_AGAINST.search(near) else 0
    edge = -1 if (a and text[a - 1].isalnum() and strict is False) or (z < len(text) and text[z].isalnum()) else 0
    # the form of a base span that failed its test speaks against it
    failed = kind == "card" and 16 <= len(digits) <= 19 and not re.search(r"[^0-9 -]", body)
    return (1 if strict else -1 if failed else 0, check, listed, around, against, edge)


def shape(kind: str, body: str) -> tuple[int, int]:
    """Coarse features of a span beside the votes: length and separators."""
    return min(7, len(body) // 6), min(3, len(set(re.sub(r"[0-9A-Za-z]", "", body))))


@dataclass
class Model:
    """Chance of each (kind, votes, shape) by the trained classifier."""

    weights: dict[str, np.ndarray]
    reliability: dict[str, np.ndarray]      # by kind: chance of a vote that is right, per labeler

    def chance(self, kind: str, v: tuple[int, ...], s: tuple[int, int]) -> float:
        w = self.weights.get(kind)
        return 0.0 if w is None else float(1 / (1 + np.exp(-float(encode(v, s) @ w))))


def encode(v: tuple[int, ...], s: tuple[int, int]) -> np.ndarray:
    return np.array([1.0, *[float(x == 1) for x in v], *[float(x == -1) for x in v], s[0] / 7, s[1] / 3])


def estimate(counts: Counter) -> Model:
    """EM over counted vote patterns, then a logistic classifier on its
    posteriors.  ``counts``: (kind, votes, shape) -> how often."""
    weights, reliability = {}, {}
    for kind in KINDS:
        own = [(v, s, n) for (k, v, s), n in sorted(counts.items()) if k == kind]
        if not own:
            continue
        v = np.array([x[0] for x in own], float)
        n = np.array([x[2] for x in own], float)
        right = np.full(v.shape[1], 0.8)             # P(vote agrees with the truth | it votes)
        prior = 0.5
        for _ in range(EM_ROUNDS):
            odds = np.log(prior / (1 - prior)) + (v * np.log(right / (1 - right))).sum(1)
            post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            agree = ((v == 1) * post[:, None] + (v == -1) * (1 - post)[:, None]) * n[:, None]
            cast = (v != 0) * n[:, None]
            right = np.clip((agree.sum(0) + 8) / (cast.sum(0) + 10), 0.55, 0.98)     # 10 imagined votes, 8 right
            prior = float(np.clip((post @ n + 1) / (n.sum() + 2), 0.05, 0.95))
        x = np.stack([encode(a, s) for a, s, _ in own])
        w = np.zeros(x.shape[1])
        for _ in range(25):                          # Newton's steps
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
            w = w + np.linalg.solve(h, x.T @ (n * (post - p)) - w)
        weights[kind], reliability[kind] = w, right
    return Model(weights, reliability)


def _holders(column: pa.Array) -> list[int]:
    """Rows whose text can hold a span."""
    return np.flatnonzero(pc.match_substring_regex(column.fill_null(""), MAY_HOLD).to_numpy(zero_copy_only=False)).tolist()


def fit(docs: DataFrame) -> Model:
    """Counts vote patterns over all texts.  There are at most kinds x 3^6 x
    32 of them, so their counts fit the driver."""
    def make(b: pa.RecordBatch):
        seen: Counter = Counter()
        col = b.column(0)
        for i in _holders(col):
            text = col[i].as_py()
            for kind, a, z, strict in candidates(text, base_spans(text)):
                seen[(kind, ",".join(map(str, votes(text, kind, a, z, strict) + shape(kind, text[a:z]))))] += 1
        if not seen:
            return None
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen]), pa.array([p for _, p in seen]), pa.array(list(seen.values()), pa.int64())],
                                          names=["kind", "pattern", "n"])
    rows = arrow_map(keyed(docs).select("text"), make, "kind string, pattern string, n long").groupBy("kind", "pattern").agg(F.sum("n").alias("n")).collect()
    counts: Counter = Counter()
    for r in rows:
        p = tuple(map(int, r["pattern"].split(",")))
        counts[(r["kind"], p[:-2], p[-2:])] = r["n"]
    return estimate(counts)


def spans(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and added spans, each by kind, then start."""
    base = base_spans(text)
    added: list[tuple[str, int, int]] = []
    for kind, a, z, strict in sorted((c for c in candidates(text, base) if not c[3]), key=lambda c: (c[1], -c[2], KINDS.index(c[0]))):
        if not any(x < z and a < y for _, x, y in added) and model.chance(kind, votes(text, kind, a, z, strict), shape(kind, text[a:z])) >= ACCEPT:
            added.append((kind, a, z))
    order = lambda s: (KINDS.index(s[0]), s[1], s[2])
    return sorted(base, key=order), sorted(added, key=order)


def digest(docs: DataFrame) -> DataFrame:
    model = fit(docs)

    def join(found):
        return ",".join(f"{k}:{a}:{z}" for k, a, z in found)

    def make(b: pa.RecordBatch):
        n, col = b.num_rows, b.column(1)
        count = np.zeros((5, n), np.int64)
        sha, text_spans = [hashlib.sha256(b"").hexdigest()] * n, [""] * n
        for i in _holders(col):
            base, added = spans(col[i].as_py(), model)
            for k, _, _ in base:
                count[KINDS.index(k), i] += 1
            count[4, i] = len(added)
            sha[i] = hashlib.sha256(join(base).encode()).hexdigest()
            text_spans[i] = join(sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
        return pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c) for c in count], pa.array(sha), pa.array(text_spans)],
                                          names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"])
    return arrow_map(keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
                     "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string")


def mask(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Every span becomes its kind in angle brackets; overlapping spans become
    one tag, that of the first.  The columns are those of ``docs``; ``n_chars``, where there is
    one, counts the new text.  Null texts stay null."""
    model = model or fit(docs)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").cast("string").alias("text"))

    def make(b: pa.RecordBatch):
        col, new = b.column(1), b.column(1).to_pylist()
        for i in _holders(col):
            text, out, end = new[i], [], 0
            base, added = spans(text, model)
            for kind, a, z in sorted(base + added, key=lambda s: (s[1], -s[2])):
                if a >= end:
                    out += [text[end:a], f"<{kind.upper()}>"]
                end = max(end, z)
            new[i] = "".join(out) + text[end:]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], names=["_row", "text"])
    got = arrow_map(packed, make, T.StructType([packed.schema["_row"], T.StructField("text", T.StringType())]))

    def column(c: str):
        if c == "text":
            return F.col("text")
        if c == "n_chars" and "text" in docs.columns:
            changed = ~F.col("text").eqNullSafe(F.col("_row.text"))
            return F.when(changed, F.length("text")).otherwise(F.col("_row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        return F.col(f"_row.`{c}`")
    return got.select(*[column(c) for c in docs.columns])
