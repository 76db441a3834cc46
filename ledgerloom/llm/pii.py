r"""Personal data: base patterns, and a character tagger that adds what they cannot find.

Base, leftmost and non-overlapping per kind: email addresses, IPv4 addresses (parts up to 255), card
numbers (12 to 19 digits that pass Luhn) and phone numbers (9 to 15 digits). A match that fails its
check is dropped and not tried again, which loses, for instance, two card numbers side by side.

The tagger (`tagger.Tagger`) learns from windows of at most LEARN_DOCS documents (LEARN_WINDOWS of those with a
labelled span, as many of those without): spans of the patterns, unchecked, as they stand there, and SPLICED and MADE windows
into which such spans, alone or side by side, and made ones of other forms are put. Other forms are phone numbers
without a plus (bracketed, or parted by hyphens, dots or blanks), addresses that write (at) or [at], and secrets
(keys and tokens of 20 to 64 letters and digits), bare or behind a word that names them. Windows of documents that
hold such a form already teach nothing, as nobody has labelled it.

Windows of WINDOW characters overlap by half; a window is decoded if it holds an at sign, a bracket, or
LEAST_DIGITS digits, as every span does. Each character takes its label from the window in which it is most central,
and spans are read from the labels of the whole text. A tagged secret or number grows to the word it lies in. What
the tagger finds is added if it has the shape and passes the check of its kind or of its other forms, stands alone
(no letter or digit of it is left outside) and overlaps no base span.

Null and empty texts have no spans; an empty table has none. Without a labelled span in the sample only the base
remains. Spans are in code points, ends exclusive. Repeated rows have equal results; ties of begin come by kind. A
pattern's work grows with the length of the text and not faster, a very long text is cut into windows like any other.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import least_hashed, set_aside, steps, texts_of, with_computed
from ledgerloom.llm.tagger import KINDS, PAD, Tagger, begin_label, classes

BASE_KINDS = KINDS[:4]

WINDOW, STRIDE, LEAST_DIGITS = 80, 40, 4
LEARN_DOCS, LEARN_WINDOWS, SPLICED, MADE = 4000, 600, 500, 1800
DECODE_AT_ONCE = 512

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SHAPES = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    "card": re.compile(r"[0-9](?:[ -]?[0-9])+"),
    "phone": _PHONE,
}
_DIGIT = re.compile("[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
_AT, _DOT = re.compile(r" ?[(\[]at[)\]] ?"), re.compile(r" ?[(\[]dot[)\]] ?")
_SECRET = re.compile("[A-Za-z0-9+/_-]{20,64}")
_SECRET_SIGN, _LETTER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"), re.compile("[A-Za-z]")
_NUMBER = re.compile(r"[(]?[0-9][0-9() .-]*[0-9]")
#: What other forms look like in a text: windows with them are not learned from.
_UNLABELLED = re.compile(r"[(]?[0-9]{2,4}[)]?[ .-]?[0-9]{3}[ .-][0-9]{3,4}|[A-Za-z0-9+/_-]{16,}|[(\[]at[)\]]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def shaped(kind: str, match: str) -> bool:
    """Whether a match of a kind's pattern has the right number of digits."""
    n = len(_DIGIT.findall(match))
    return {"card": 12 <= n <= 19, "phone": 9 <= n <= 15}.get(kind, True)


def valid(kind: str, match: str) -> bool:
    if kind == "ip":
        return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in match.split("."))
    if kind == "card":
        return shaped(kind, match) and luhn("".join(_DIGIT.findall(match)))
    return shaped(kind, match)


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def _dotted(text: str):
    """Four parts at a time from each run of digits and dots."""
    for run in _DOTTED.finditer(text):
        at = run.start()
        parts = run.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            own = ".".join(parts[k: k + 4])
            yield at, at + len(own)
            at += len(own) + 1


def other_form(kind: str, own: str) -> bool:
    """Whether a text is of a form that no base pattern has."""
    if kind == "email":
        return bool(_AT.search(own)) and bool(_SHAPES["email"].fullmatch(_DOT.sub(".", _AT.sub("@", own))))
    if kind == "phone":
        return bool(_NUMBER.fullmatch(own)) and 10 <= len(_DIGIT.findall(own)) <= 15 and len(own) <= 24 and bool(re.search("[().-]", own))
    if kind == "secret":
        return bool(_SECRET.fullmatch(own)) and len(_DIGIT.findall(own)) >= 4 and len(_LETTER.findall(own)) >= 4
    return False


def matches(text: str) -> list[tuple[int, int, int]]:
    """(begin, end, kind) of every match of the patterns, unchecked."""
    if not _TRIGGER.search(text):
        return []
    found = [(a, b, 0) for a, b in _emails(text)]
    found += [(a, b, 1) for a, b in _dotted(text)]
    found += [(m.start(), m.end(), 2) for m in _DIGITS.finditer(text)]
    return found + [(m.start(), m.end(), 3) for m in _PHONE.finditer(text)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, end, kind) by begin, then kind."""
    return sorted(((a, b, k) for a, b, k in matches(text) if valid(KINDS[k], text[a:b])), key=lambda s: (s[0], s[2]))


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Begins and classes (window, time) of the windows that can hold a span."""
    own = classes(text)
    begins = np.arange(0, max(len(own) - WINDOW + STRIDE, 1), STRIDE)
    padded = np.full(int(begins[-1]) + WINDOW, PAD, np.uint8)
    padded[: len(own)] = own
    digits, marks = (np.concatenate([[0], np.cumsum(np.isin(padded, [ord(c) for c in some]))]) for some in ("0", "@(["))
    wanted = (digits[begins + WINDOW] - digits[begins] >= LEAST_DIGITS) | (marks[begins + WINDOW] > marks[begins])
    begins = begins[wanted]
    return begins, padded[begins[:, None] + np.arange(WINDOW)]


def reconciled(length: int, begins: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Label of each character from the window in which it is most central."""
    whole = np.zeros(length + WINDOW, np.int8)
    core = slice((WINDOW - STRIDE) // 2, (WINDOW + STRIDE) // 2)
    for a, own in zip(begins.tolist(), labels):
        part = whole[a: a + WINDOW]
        part[part == 0] = own[part == 0]
    for a, own in zip(begins.tolist(), labels):
        whole[a + core.start: a + core.stop] = own[core]
        if a == 0:
            whole[: core.start] = own[: core.start]
    return whole[:length]


def _tagged(text: str, labels: np.ndarray):
    """(begin, end, kind) of the labelled spans, without blanks and marks around them."""
    for a in np.flatnonzero(labels % 2 == 1).tolist():
        inside = labels[a] + 1
        b = a + 1
        while b < len(labels) and labels[b] == inside:
            b += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        yield a, b, int(inside) // 2 - 1


def _grown(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """A secret or number with what is left of its word on both sides."""
    signs = {"secret": _SECRET_SIGN, "phone": frozenset("0123456789")}.get(kind, frozenset())
    while a and text[a - 1] in signs and b - a < 80:
        a -= 1
    while b < len(text) and text[b] in signs and b - a < 80:
        b += 1
    if kind == "phone" and a and text[a - 1] == "(" and ")" in text[a:b]:
        a -= 1
    return a, b


def _alone(text: str, a: int, b: int) -> bool:
    return not (text[a - 1: a].isalnum() if a else False) and not text[b: b + 1].isalnum()


def added_spans(text: str, base: list, labels: np.ndarray) -> list[tuple[int, int, int]]:
    taken = np.zeros(len(text) + 1, bool)
    for a, b, _ in base:
        taken[a:b] = True
    found = []
    for a, b, k in _tagged(text, labels):
        kind = KINDS[k]
        if b > a:
            a, b = _grown(text, a, b, kind)
        own = text[a:b]
        fits = other_form(kind, own) or kind in _SHAPES and _SHAPES[kind].fullmatch(own) and valid(kind, own)
        if b > a and not taken[a:b].any() and fits and _alone(text, a, b):
            found.append((a, b, k))
            taken[a:b] = True
    return found


def all_spans(texts: list[str], model: Tagger | None) -> list[list[tuple[int, int, int, bool]]]:
    """(begin, end, kind, whether base) per text, by begin, then kind."""
    base = [base_spans(t) for t in texts]
    added: list[list] = [[] for _ in texts]
    if model is not None:
        some = [i for i, t in enumerate(texts) if _TRIGGER.search(t)]
        cut = {i: windows(texts[i]) for i in some}
        stacked = np.concatenate([cut[i][1] for i in some]) if some else np.zeros((0, WINDOW), np.uint8)
        labels = [model.decode(stacked[i: i + DECODE_AT_ONCE]) for i in range(0, len(stacked), DECODE_AT_ONCE)]
        labels, at = np.concatenate(labels) if labels else stacked.astype(np.int8), 0
        for i in some:
            begins = cut[i][0]
            own, at = labels[at: at + len(begins)], at + len(begins)
            if own.any():
                added[i] = added_spans(texts[i], base[i], reconciled(len(texts[i]), begins, own))
    return [sorted([(*s, True) for s in b] + [(*s, False) for s in a], key=lambda s: (s[0], s[2])) for b, a in zip(base, added)]


def _taught(text: str) -> list[tuple[bytes, bytes]]:
    """Windows of a text with labels from the patterns; none with a match of the wrong number of digits."""
    found = matches(text)
    labels, unclear = np.zeros(len(text) + WINDOW, np.int8), np.zeros(len(text) + WINDOW, bool)
    for a, b, k in sorted(found, key=lambda s: (s[2] == 2, s[0])):  # digits of another kind are no card
        if not shaped(KINDS[k], text[a:b]):
            unclear[a:b] |= k == 3 or b - a > 19
        elif not labels[a:b].any():
            labels[a:b] = begin_label(k) + 1
            labels[a] = begin_label(k)
    rows = []
    for m in _UNLABELLED.finditer(text):
        if not labels[m.start(): m.end()].any():
            unclear[m.start(): m.end()] = True
    for a, x in zip(*windows(text)):
        y = labels[a: a + WINDOW]
        if not unclear[a: a + WINDOW].any() and not (y[0] and y[0] % 2 == 0):  # nor with a span that begins before
            rows.append((x.tobytes(), y.tobytes()))
    return rows


def _spliced(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows with one span, or two of a kind with a blank between them, put into a window without any."""
    draw = np.random.default_rng(11)
    spans: list[list] = [[] for _ in KINDS]
    for own, labels in zip(x, y):
        for a in np.flatnonzero(labels % 2 == 1):
            same = np.flatnonzero(labels[a + 1:] != labels[a] + 1)
            b = a + 1 + (same[0] if len(same) else WINDOW)
            if b < WINDOW:
                spans[(labels[a] - 1) // 2].append((own[a:b], labels[a:b]))
    kinds = [s for s in spans if s]
    plain = np.flatnonzero(~y.any(1))
    blank = (np.array([32], np.uint8), np.array([0], np.int8))
    rows = []
    for k in range(n if kinds else 0):
        own = kinds[k % len(kinds)]
        parts = [own[i] for i in draw.integers(len(own), size=1 + k // len(kinds) % 2)]
        put = [blank, *(z for part in parts for z in (part, blank))]
        xs, ys = (np.concatenate(z)[: WINDOW - 4] for z in zip(*put))
        around = x[plain[draw.integers(len(plain))]] if len(plain) else np.full(WINDOW, ord("a"), np.uint8)
        around = np.where((around == ord("0")) | (around == ord("@")), ord("a"), around).astype(np.uint8)
        at = int(draw.integers(WINDOW - len(xs) + 1))
        left = np.concatenate([around[:at], xs, around[at: WINDOW - len(xs)]])
        labels = np.zeros(WINDOW, np.int8)
        labels[at: at + len(xs)] = ys
        rows.append((left, labels))
    if not rows:
        return x[:0], y[:0]
    return tuple(np.stack(z) for z in zip(*rows))


_NAMES = ("token = ", "key: ", "api_key=", "secret ", "password: ", "Bearer ", "")
_PHONES = ("(ddd) ddd-dddd", "(ddd)ddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd", "(dd) dddd-dddd", "(ddd) ddd dddd")
_SIGNS = {"hex": "0123456789abcdef", "any": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}


def made_span(draw: np.random.Generator) -> tuple[str, str, str, int]:
    """What stands before, a made span of another form, what stands behind, and its kind."""

    def some(signs: str, n: int) -> str:
        return "".join(signs[i] for i in draw.integers(len(signs), size=n))

    def one(of):
        return of[int(draw.integers(len(of)))]

    kind = int(draw.integers(3))
    if kind == 0:
        form = one(_PHONES)
        return one(("call ", "tel. ", "at ", "")), "".join(some("0123456789", 1) if c == "d" else c for c in form), "", KINDS.index("phone")
    if kind == 1:
        letters = "abcdefghijklmnopqrstuvwxyz"
        at, dot = one(("(at)", " (at) ", "[at]", " [at] ")), one((".", ".", "[dot]", " (dot) "))
        return "", some(letters, int(draw.integers(3, 9))) + at + some(letters, int(draw.integers(3, 9))) + dot + one(("com", "org", "net", "de")), "", 0
    secret = one(("", "", "sk_")) + some(_SIGNS[one(("hex", "hex", "any", "upper"))], int(draw.integers(24, 44)))
    quote = one(('"', "'", ""))
    return one(_NAMES) + quote, secret, quote, KINDS.index("secret")


def made_windows(plain: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of `plain` (without a span) into each of which a made span is put, with their labels."""
    draw, xs, ys = np.random.default_rng(seed), [], []
    for _ in range(n):
        before, span, behind, kind = made_span(draw)
        own = classes(f" {before}{span}{behind} ")[: WINDOW - 2]
        labels = np.zeros(len(own), np.int8)
        a = 1 + len(before)
        labels[a: a + len(span)] = begin_label(kind) + 1
        labels[a: a + 1] = begin_label(kind)
        around = plain[draw.integers(len(plain))] if len(plain) else np.full(WINDOW, ord("a"), np.uint8)
        around = np.where(np.isin(around, [ord("0"), ord("@")]), ord("a"), around).astype(np.uint8)
        at = int(draw.integers(WINDOW - len(own) + 1))
        xs.append(np.concatenate([around[:at], own, around[at: WINDOW - len(own)]]))
        ys.append(np.concatenate([np.zeros(at, np.int8), labels, np.zeros(WINDOW - len(own) - at, np.int8)]))
    return np.stack(xs), np.stack(ys)


def learned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Tagger | None:
    """A tagger of the windows of LEARN_DOCS documents, those of the least hash of their id."""
    plain = texts_of(docs, doc_id, text)
    some = least_hashed(plain.select("doc_id"), "doc_id", LEARN_DOCS)

    def cut(batches):
        for batch in batches:
            for step in steps(batch, "text"):
                rows = [(x, y, any(y)) for t in step.column(0).to_pylist() for x, y in _taught(t)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), (pa.binary(), pa.binary(), pa.bool_()))],
                                                     names=["x", "y", "found"])

    taught = plain.join(F.broadcast(some), "doc_id").select("text").mapInArrow(cut, "x binary, y binary, found boolean").distinct()  # at most LEARN_DOCS ids
    picked = taught.withColumn("h", F.xxhash64("x", "y"))
    rows = [r for found in (True, False) for r in picked.filter(F.col("found") == found).orderBy("h", "x", "y").limit(LEARN_WINDOWS).collect()]
    if not any(r["found"] for r in rows):
        return None
    x = np.stack([np.frombuffer(r["x"], np.uint8) for r in rows])
    y = np.stack([np.frombuffer(r["y"], np.int8) for r in rows])
    more_x, more_y = _spliced(x, y, SPLICED)
    made_x, made_y = made_windows(x[~y.any(1)], MADE, 13)
    return Tagger().fit(np.concatenate([x, more_x, made_x]), np.concatenate([y, more_y, made_y]))


SPANS = "spans array<struct<begin: long, end: long, kind: string, base: boolean>>"
_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())])


def found_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep=None) -> DataFrame:
    """docs (or its columns in keep) with their spans, by begin, then kind."""
    model = learned(docs, doc_id, text)

    def spans(texts: pa.Array):
        found = all_spans([t or "" for t in texts.to_pylist()], model)
        return [pa.array([[{"begin": a, "end": b, "kind": KINDS[k], "base": base} for a, b, k, base in own] for own in found], pa.list_(_SPAN))]

    return with_computed(docs, SPANS, spans, text, keep=keep)


def listed(spans: Column) -> Column:
    """kind:begin:end of each span, parted by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def _masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, at = [], 0
    for a, b, k, _ in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans by that of the first."""
    model = learned(docs, doc_id, text)

    def mask(texts: pa.Array):
        own = texts.to_pylist()
        found = all_spans([t or "" for t in own], model)
        return [pa.array([_masked(t, s) if s else t for t, s in zip(own, found)], pa.string())]

    own, names, back = set_aside(docs)
    masked = with_computed(own, "masked string", mask, names[text])
    return back(masked.withColumn(names[text], F.col("masked")))
