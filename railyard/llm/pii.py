"""Personal data by a semi-Markov conditional random field over whole spans (operator 5).

Texts are cut into windows around tokens that hold a digit, ``@`` or a bracketed "at". Within a window the atoms (runs
of letters, runs of digits, single other characters) form a lattice: every run of at most ``MAX_ATOMS`` atoms that may
be an entity of some kind is a candidate segment, scored by weights of features of the whole span (digit count and
grouping, check digit, octet range, separators, domain, what stands on either side). Dynamic programming over the
lattice chooses boundaries and kinds jointly; all other atoms are outside.

The weights are trained here by maximum conditional likelihood on windows that a rule writes out (all usual ways to
write the four kinds, and numbers that are none of them), and on the windows of about ``FIT_DOCS`` documents, labelled
by the fixed patterns below. Both bounds are documented parameters; prediction covers whole texts.

The fixed patterns' spans always stay; the model adds spans that overlap none of them. Defined cases: a null text
counts as empty and has no spans; offsets are code points, ends exclusive; repeated rows get equal results; other
columns take no part.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import documents

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 20
FIT_DOCS = 2000
FIT_WINDOWS = 400
WRITTEN_WINDOWS = 480

Span = tuple[str, int, int]

# --- fixed patterns -------------------------------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the local part, ``@`` and a dotted domain, found from the ``@`` outwards."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end if m else 0))


def _ascii_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    out = list(_emails(text)) if "@" in text else []
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p[-9:]) <= 255 and (len(p) < 10 or not p[:-9].strip("0"))
                                                                 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _ascii_digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_ascii_digits(m[0])) <= 15]
    return out


# --- windows, atoms, candidate segments ------------------------------------------------------------------------------

_TOKEN = re.compile(r"\S+")
_ANCHOR = re.compile(r"[0-9@]|[\[({]\s*at\s*[\])}]", re.I)
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s|.", re.S)
_BRACKETED_AT = re.compile(r"[\[({]at[\])}]", re.I)


def windows(text: str) -> list[tuple[int, int]]:
    """Spans of text around anchors: a token before, and up to three tokens between or after them."""
    out: list[tuple[int, int]] = []
    for m in _ANCHOR.finditer(text):
        if out and m.start() < out[-1][1]:
            continue
        lo = m.start()
        floor = out[-1][1] if out else 0
        for _ in range(2):  # to the start of this token, then of the one before
            while lo > floor and text[lo - 1].isspace():
                lo -= 1
            while lo > floor and not text[lo - 1].isspace():
                lo -= 1
        hi, quiet = m.end(), 0
        while quiet < 3:
            token = _TOKEN.search(text, hi)
            if not token or token.start() - hi > 3:
                break
            quiet = 0 if _ANCHOR.search(token[0]) else quiet + 1
            hi = token.end()
        out.append((lo, max(hi, m.end())))
    return out


def _grouping(parts: list[str]) -> str:
    return "-".join(str(min(len(p), 5)) for p in parts[:5])


def _segment(kind: str, atoms: list[str], i: int, j: int) -> list[str] | None:
    """Features of atoms i..j as an entity of ``kind``; None if they can't be one."""
    span = "".join(atoms[i:j])
    first, last = span[0], span[-1]
    digits = _ascii_digits(span)
    others = {c for c in span if not "0" <= c <= "9"}
    left, right = (atoms[i - 1] if i else ""), (atoms[j] if j < len(atoms) else "")
    out = [kind]
    if kind == "email":
        if not (first.isalnum() and last.isalpha()) or not ("@" in span or _BRACKETED_AT.search(span)):
            return None
        plain = re.sub(r"\s*[\[({]dot[\])}]\s*|\s+dot\s+", ".", re.sub(r"\s*[\[({]at[\])}]\s*", "@", span, flags=re.I), flags=re.I)
        if plain.count("@") != 1:
            return None
        local, domain = plain.split("@")
        labels = domain.split(".")
        out += [f"email local {'ok' if re.fullmatch(r'[A-Za-z0-9._%+-]+', local) else 'bad'}",
                f"email domain {'ok' if re.fullmatch(r'[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*', domain) else 'bad'}",
                f"email labels {min(len(labels), 4)}", f"email top {min(len(labels[-1]), 5) if labels[-1].isalpha() else 0}",
                f"email open {left == '.' or right == '.' and not atoms[j + 1:j + 2] == [' ']}"]
    elif kind == "ip":
        parts = re.split(r"\s?[\[({]?(?:\.|dot)[\])}]?\s?", span)
        if not ("0" <= first <= "9" and "0" <= last <= "9") or len(parts) != 4 or not all(p.isdigit() and p.isascii() for p in parts):
            return None
        out += [f"ip octets {all(len(p) < 4 and int(p) < 256 for p in parts)}", f"ip bare {others == {'.'}}",
                f"ip digits {min(len(digits), 8)}", f"ip dotted {left in ('.', '-') or right == '.' and atoms[j + 1:j + 2] != [' ']}"]
    else:
        allowed = set(" -.") if kind == "card" else set(" -.()+/")
        if not others <= allowed or not "0" <= last <= "9" or not ("0" <= first <= "9" or kind == "phone" and first in "+("):
            return None
        if not (12 <= len(digits) <= 20 if kind == "card" else 6 <= len(digits) <= 16):
            return None
        parts = re.findall("[0-9]+", span)
        if kind == "card":
            out += [f"card check {13 <= len(digits) <= 19 and luhn(digits)}", f"card digits {len(digits)}",
                    f"card groups {min(len(parts), 6)}", f"card separators {''.join(sorted(others))}",
                    f"card even {all(len(p) == 4 for p in parts[:-1])}"]
        else:
            out += [f"phone plus {first == '+'}", f"phone digits {len(digits)}", f"phone grouping {_grouping(parts)}",
                    f"phone brackets {'(' in others and ')' in others and span.count('(') == span.count(')') == 1}",
                    f"phone separators {''.join(sorted(others - set('+()')))}", f"phone groups {min(len(parts), 6)}"]
            if "+" in span[1:]:
                return None
    for name, near in (("left", left), ("right", right)):
        shape = "none" if not near else "digit" if near[0].isdigit() else "letter" if near[0].isalpha() else \
            "blank" if near.isspace() else "join" if near in "+-/#@_=" else "mark"
        out.append(f"{kind} {name} {shape}")
    return out


_HAS = {"email": re.compile(r"@|[\[({]at[\])}]", re.I), "ip": re.compile("[0-9]"), "card": re.compile("[0-9]"), "phone": re.compile("[0-9]")}


def candidates(atoms: list[str]) -> list[tuple[int, int, str, list[str]]]:
    """(i, j, kind, features) of all segments of at most MAX_ATOMS atoms that may be entities."""
    n = len(atoms)
    numeric = [a.isdigit() or a in " -.()+/" for a in atoms]
    at_sign = [a == "@" or a.lower() == "at" and 0 < x < n - 1 and atoms[x - 1] in "[({" and atoms[x + 1] in "])}"
               for x, a in enumerate(atoms)]
    out = []
    for i, a in enumerate(atoms):
        if a.isspace() or not (a[0].isalnum() or a in "+("):
            continue
        digits, only_numeric, seen_at = 0, True, False
        for j in range(i + 1, min(n, i + MAX_ATOMS) + 1):
            x = j - 1
            digits += len(atoms[x]) if atoms[x].isdigit() else 0
            only_numeric &= numeric[x]
            seen_at |= at_sign[x]
            if digits > 20 and only_numeric:
                break
            kinds = []
            if atoms[x].isdigit():
                if only_numeric and digits >= 6:
                    kinds += ["card", "phone"]
                if digits >= 4 and j - i >= 7 and atoms[i].isdigit():
                    kinds.append("ip")
            elif seen_at and atoms[x].isalpha():
                kinds.append("email")
            for kind in kinds:
                features = _segment(kind, atoms, i, j)
                if features:
                    out.append((i, j, kind, features))
    return out


# --- training and decoding -------------------------------------------------------------------------------------------

def _log_likelihood_gradient(n: int, segments: list[tuple[int, int, np.ndarray]], gold: set[int], w: np.ndarray) -> Counter:
    """Observed minus expected feature counts of one window; segments: (i, j, feature numbers)."""
    score = [float(w[f].sum()) for _, _, f in segments]
    ends, begins = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
    for k, (i, j, _) in enumerate(segments):
        ends[j].append(k)
        begins[i].append(k)

    def total(terms: list[float]) -> float:
        m = max(terms)
        return m + math.log(sum(math.exp(t - m) for t in terms))

    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        forward[j] = total([forward[j - 1], *(forward[segments[k][0]] + score[k] for k in ends[j])])
    for i in range(n - 1, -1, -1):
        backward[i] = total([backward[i + 1], *(backward[segments[k][1]] + score[k] for k in begins[i])])
    out: Counter = Counter()
    for k, (i, j, features) in enumerate(segments):
        delta = (k in gold) - math.exp(forward[i] + score[k] + backward[j] - forward[n])
        if abs(delta) > 1e-4:
            for f in features:
                out[int(f)] += delta
    return out


def train(examples: list[tuple[str, list[Span]]], rounds: int = 12, rate: float = 0.5, decay: float = 2e-3) -> dict[str, float]:
    """Feature weights from (window, spans) pairs, by Adagrad on the conditional likelihood."""
    names: dict[str, int] = {}
    data = []
    for text, spans in examples:
        atoms, starts = _atoms(text)
        found = candidates(atoms)
        edges = [*starts, len(text)]
        want = set(spans)
        gold = {k for k, (i, j, kind, _) in enumerate(found) if (kind, edges[i], edges[j]) in want}
        data.append((len(atoms), [(i, j, np.array([names.setdefault(f, len(names)) for f in fs])) for i, j, _, fs in found], gold))
    w, seen = np.zeros(len(names)), np.full(len(names), 1e-6)
    for _ in range(rounds):
        for n, segments, gold in data:
            if not segments:
                continue
            for f, g in _log_likelihood_gradient(n, segments, gold, w).items():
                g -= decay * w[f]
                seen[f] += g * g
                w[f] += rate * g / math.sqrt(seen[f])
    return {name: float(w[f]) for name, f in names.items()}


def _atoms(text: str) -> tuple[list[str], list[int]]:
    atoms, starts = [], []
    for m in _ATOM.finditer(text):
        atoms.append(m[0])
        starts.append(m.start())
    return atoms, starts


def decode(text: str, weights: dict[str, float]) -> list[Span]:
    """The best segmentation's entities. A feature never seen in training counts against the segment."""
    atoms, starts = _atoms(text)
    found = candidates(atoms)
    if not found:
        return []
    n = len(atoms)
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    ends: dict[int, list] = {}
    for i, j, kind, features in found:
        ends.setdefault(j, []).append((i, kind, sum(weights.get(f, -1.0) for f in features)))
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, kind, score in ends.get(j, ()):
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind)
    out, j, edges = [], n, [*starts, len(text)]
    while j > 0:
        if back[j]:
            i, kind = back[j]
            out.append((kind, edges[i], edges[j]))
            j = i
        else:
            j -= 1
    return out[::-1]


# --- training windows ------------------------------------------------------------------------------------------------

def written_windows(n: int = WRITTEN_WINDOWS) -> list[tuple[str, list[Span]]]:
    """Examples by rule: for each kind its usual ways of writing, and numbers that are no personal data."""
    rng = np.random.RandomState(7)

    def digits(k: int, first: str = "123456789") -> str:
        return first[rng.randint(len(first))] + "".join(str(d) for d in rng.randint(0, 10, k - 1))

    def word() -> str:
        return "".join("abcdefghijklmnoprstuvw"[x] for x in rng.randint(0, 22, rng.randint(2, 9)))

    def pick(*xs):
        return xs[rng.randint(len(xs))]

    def card() -> str:
        while True:
            d = digits(16, "3456")
            if luhn(d):
                return pick(d, *[s.join(d[k:k + 4] for k in range(0, 16, 4)) for s in " -."])

    def phone() -> str:
        a, b, c = digits(3, "23456789"), digits(3, "23456789"), digits(4)
        s = pick(" ", "-", ".")
        return pick(f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1{s}{a}{s}{b}{s}{c}", f"1-{a}-{b}-{c}",
                    f"+{digits(2)} {digits(3)} {digits(7)}", f"({a}){s}{b}{s}{c}", f"+1{a}{b}{c}")

    def email() -> str:
        local, domain, top = pick(word(), f"{word()}.{digits(2)}", f"{word()}_{word()}"), pick(word(), f"{word()}{digits(1)}"), pick("com", "org", "net", "de")
        domain = pick(domain, f"{domain}.example")
        dotted = pick(f"{domain}.{top}", f"{domain}.{top}".replace(".", " dot "), f"{domain}.{top}".replace(".", "[dot]"))
        return pick(f"{local}@{domain}.{top}", f"{local} (at) {dotted}", f"{local}[at]{dotted}", f"{local} [at] {dotted}")

    def ip() -> str:
        parts = [str(x) for x in rng.randint(1, 256, 4)]
        return pick(".".join(parts), "[.]".join(parts), "(.)".join(parts))

    def nothing() -> str:
        bad = digits(pick(13, 15, 16, 17), "123456789")
        return pick(f"{digits(1)}.{digits(1)}", f"version {digits(1)}.{digits(1)}.{digits(1)}", digits(rng.randint(1, 13)), digits(9),
                    f"20{digits(2)}-0{digits(1)}-{digits(2, '12')}", f"{digits(2, '12')}:{digits(2, '12345')}", f"{digits(3)},{digits(3)},{digits(3)}",
                    f"{digits(2)}/{digits(2)}/20{digits(2)}", bad if not luhn(bad) else digits(5), f"{digits(3)}.{digits(3)}.{digits(3, '3456789')}.999",
                    f"{digits(3)}-{digits(3)}", f"{word()}{digits(6)}{word()}{digits(8)}{word()}", f"{digits(4)} {digits(4)}", f"{digits(2)} {digits(3)} {digits(2)}",
                    f"@{word()}", f"{digits(4)}-{digits(4)}", f"{digits(1)}.{digits(2)}.{digits(1)}.{digits(1)}.{digits(1)}", f"{digits(3)} - {digits(3)}", f"{digits(10)}")

    out = []
    for _ in range(n):
        text, spans = word(), []
        for _ in range(rng.randint(1, 3)):
            kind, make = (("email", email), ("ip", ip), ("card", card), ("phone", phone), (None, nothing), (None, nothing))[rng.randint(6)]
            item = make()
            text += pick(" ", " ", ": ")
            if kind:
                spans.append((kind, len(text), len(text) + len(item)))
            text += item + pick("", "", ".", ",") + f" {word()}"
        out.append((text, spans))
    return out


def _fit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text[lo:hi] for text in batch.column(0).to_pylist() if text for lo, hi in windows(text) if hi - lo <= 300]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["window"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, float]:
    """Train on the written windows and those of the documents with the smallest hashes."""
    n = docs.count()
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) * F.lit(n) <= F.lit(FIT_DOCS << 30)
    sample = docs.where(draw).select(F.col(text_col).alias("text")).mapInArrow(_fit_windows, "window string").distinct()
    rows = sample.orderBy(F.xxhash64("window"), "window").limit(FIT_WINDOWS).collect()
    return train(written_windows() + [(r.window, base_spans(r.window)) for r in rows])


# --- applying --------------------------------------------------------------------------------------------------------

def find(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """(fixed patterns' spans, all spans), each by kind as listed, then start."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    spans, x = list(base), 0
    for lo, hi in windows(text):
        while x < len(taken) and taken[x][1] <= lo:
            x += 1
        near = [t for t in taken[x:x + 64 + hi - lo] if t[0] < hi]
        spans += [(k, lo + s, lo + e) for k, s, e in decode(text[lo:hi], weights) if all(lo + e <= a or b <= lo + s for a, b in near)]
    rank = KINDS.index
    return sorted(base, key=lambda t: (rank(t[0]), t[1])), sorted(spans, key=lambda t: (rank(t[0]), t[1]))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _texts(column: pa.Array) -> Iterator[str]:
    """The texts, or an empty one where there is neither digit nor at sign to look at."""
    column = column.fill_null("")
    marked = pc.match_substring_regex(column, r"[0-9@]|[\[({]\s*(?i:at)\s*[\])}]")
    for text, some in zip(column, marked):
        yield text.as_py() if some.as_py() else ""


def _spans(weights: dict[str, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        counts, shas, written = [], [], []
        for text in _texts(batch.column(1)):
            base, spans = find(text, weights) if text else ([], [])
            kinds = Counter(k for k, _, _ in base)
            counts.append([kinds[k] for k in KINDS])
            shas.append(hashlib.sha256(_written(base).encode()).hexdigest() if base else nothing)
            written.append(_written(spans))
        n = np.array(counts, np.int64).reshape(-1, len(KINDS))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(n[:, k]) for k in range(len(KINDS))), pa.array(shas, pa.string()),
                                          pa.array(written, pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span (of overlapping ones, their union) replaced by its kind in angle brackets."""
    out, at, until = [], 0, 0
    for kind, s, e in sorted(spans, key=lambda t: (t[1], -t[2])):
        if s >= until:
            out += [text[at:s], f"<{kind}>"]
        at = until = max(until, e)
    return "".join(out) + text[at:]


def _redacted(weights: dict[str, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole, out = batch.column(1), []
        for x, text in enumerate(_texts(whole)):
            spans = find(text, weights)[1] if text else []
            out.append(redact(text, spans) if spans else whole[x].as_py())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "clean_text"])


def personal_data(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    two = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = two.schema["doc_id"].dataType.simpleString()
    return two.mapInArrow(partial(_spans, weights), f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
                          + ", base_sha256 string, spans string")


def redacted(docs: DataFrame, weights: dict[str, float], text_col: str = "text") -> DataFrame:
    """``docs``, all columns kept, with the spans replaced in the text."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != text_col])
    two = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    out = two.mapInArrow(partial(_redacted, weights), f"row {two.schema['row'].dataType.simpleString()}, clean_text string")
    return out.select(*[F.col("clean_text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return personal_data(docs, learn(docs))
