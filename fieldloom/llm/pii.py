"""Personal data: patterns, and a semi-Markov conditional random field that adds spans.

Windows around digits and at-signs are cut into atoms (runs of letters, runs of
digits, single other characters). A segment of at most ``MAX_ATOMS`` atoms may
carry one of the kinds; features look at the whole segment: its form, number of
digits, check digit, grouping, and what stands beside it. Dynamic programming over
segment ends chooses boundaries and kinds together; everything else is outside.

The field is trained on a bounded sample of windows whose labels are the
patterns' matches, and on copies of them written in other ways (grouped card
numbers, phone numbers without a plus, spelt-out at-signs), by the conditional
likelihood with forward and backward sums over segments.
"""

from __future__ import annotations

import math
import re
import string
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import pieces, sha256_hex, table

# Kinds in their order, and the patterns of the base matches.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits does, and a run is taken whole: the same matches as with plain runs, in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Atoms of a segment at most; characters of context on each side of a window.
MAX_ATOMS, CONTEXT = 24, 32
#: About so many documents, and at most so many windows, are trained on.
TRAIN_DOCS, TRAIN_WINDOWS = 20_000, 400
ROUNDS, RATE, DECAY = 60, 0.5, 0.01

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_parts(address: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in address.split(".")))


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns that pass their checks, by kind, then start."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            out.append((start, end, "email"))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if small_parts(m.group()):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := digits_of(m.group())) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(digits_of(m.group())) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


# --- windows, segments, features --------------------------------------------------------------

ATOM = re.compile(r"[^\W\d_]+|[0-9]+|.", re.S)
NUMBERS = re.compile(r"[0-9](?:[\x20().+-]{0,2}[0-9]){6,}")
SPELT = re.compile(r"@|[(\[] ?at ?[)\]]", re.I)
HOST = re.compile(r" ?[A-Za-z0-9._%+-]*(?: ?[(\[] ?dot ?[)\]] ?[A-Za-z0-9-]+)*", re.I)
MORE_HOST = re.compile(r"(?:\.| ?[(\[] ?dot ?[)\]] ?)[A-Za-z0-9-]", re.I)
CARD_FORM = re.compile(r"[0-9](?:[\x20.-]?[0-9]){12,18}")
PHONE_FORM = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){7,14}")
IP_FORM = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
EMAIL_FORM = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|[(\[] ?at ?[)\]]) ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[] ?dot ?[)\]]) ?[A-Za-z0-9-]+)+", re.I)
CUES = {"email": {"mail", "email", "contact"}, "ip": {"ip", "host", "address", "server"}, "card": {"card", "visa", "credit"}, "phone": {"tel", "phone", "call", "fax", "mobile"}}


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and at-signs: ``CONTEXT`` characters on both sides, and around an at-sign the whole name and host, however long."""
    hits = [(*m.span(), False) for m in NUMBERS.finditer(text)]
    if "@" in text or "(" in text or "[" in text:
        hits += [(*m.span(), True) for m in SPELT.finditer(text)]
    out: list[tuple[int, int]] = []
    for start, end, spelt in sorted(hits):
        low, high = start - CONTEXT, end + CONTEXT
        if spelt:
            name = start - (start > 0 and text[start - 1] == " ")
            while name > 0 and text[name - 1] in LOCAL:
                name -= 1
            low, high = min(low, name), max(high, HOST.match(text, end).end())
        low, high = max(0, low), min(len(text), high)
        while out and low <= out[-1][1]:
            before = out.pop()
            low, high = min(low, before[0]), max(high, before[1])
        out.append((low, high))
    return out


def segments(text: str) -> tuple[list[int], dict[int, list[tuple[int, str, list[str]]]]]:
    """Atom bounds of a window, and by last atom the segments: (first bound, kind, features)."""
    bounds = [0, *(m.end() for m in ATOM.finditer(text))]
    count = len(bounds) - 1
    first = [text[bounds[k]] for k in range(count)]
    spelt = SPELT.search(text) is not None
    found: dict[int, list[tuple[int, str, list[str]]]] = defaultdict(list)
    for i in range(count):
        number = first[i] in "+(" or "0" <= first[i] <= "9"
        if not number and not (spelt and (first[i] in LOCAL)):
            continue
        for j in range(i + 1, min(count, i + MAX_ATOMS) + 1):
            tail = first[j - 1]
            if not tail.isalnum() or not tail.isascii():
                continue
            span = text[bounds[i]:bounds[j]]
            kinds = [kind for kind, form in (("ip", IP_FORM), ("card", CARD_FORM), ("phone", PHONE_FORM)) if number and form.fullmatch(span)]
            if spelt and EMAIL_FORM.fullmatch(span):
                kinds.append("email")
            for kind in kinds:
                found[j].append((i, kind, features(text, bounds[i], bounds[j], kind)))
    return bounds, found


def features(text: str, start: int, end: int, kind: str) -> list[str]:
    """Names of the features of a whole segment."""
    span = text[start:end]
    digits = digits_of(span)
    before, after = text[start - 1:start], text[end:end + 1]
    out = ["bias", f"digits {min(len(digits), 20)}" if kind in ("card", "phone") else "-"]
    out.append("glued" if before.isalnum() or after.isalnum() else "free")
    if re.search(r"[0-9][\x20().-]{0,2}$", text[max(0, start - 3):start]) or re.match(r"[\x20().-]{0,2}[0-9]", text[end:end + 3]):
        out.append("number goes on")
    if before and before in "._%+-/=#@" or after and after in "@/=#_%":
        out.append("symbol beside")
    words = re.findall(r"[a-z]+", text[max(0, start - CONTEXT):start].lower())[-3:]
    if CUES[kind] & set(words):
        out.append("cue")
    if kind == "card":
        out.append("check digit" if luhn(digits) else "no check digit")
        groups = re.split(r"[\x20.-]", span)
        out.append("one group" if len(groups) == 1 else "groups of four" if all(len(g) == 4 for g in groups[:-1]) else "odd groups")
        out.append("long enough" if len(digits) >= 16 else "short")
    elif kind == "phone":
        out.append("plus" if span[0] == "+" else "no plus")
        shape = re.sub("[0-9]", "d", span)
        out.append("area and line" if re.fullmatch(r"(?:\+d{1,3}[\x20.-]?)?\(?d{3}\)?[\x20.-]?d{3}[\x20.-]d{4}", shape) else "other shape")
        out.append("unbalanced" if span.count("(") != span.count(")") else "balanced")
        if span.isdigit():
            out.append("bare digits")
    elif kind == "ip":
        out.append("small parts" if small_parts(span) else "large part")
    else:
        out.append("at-sign" if "@" in span else "spelt")
        out.append("domain word" if re.search(r"[A-Za-z]{2,}$", span) else "odd domain")
        if MORE_HOST.match(text, end):
            out.append("host goes on")
    return [f"{kind} {name}" for name in out]


Weights = dict[str, float]


def decode(text: str, weights: Weights) -> list[Span]:
    """The best segmentation of a window."""
    bounds, found = segments(text)
    if not found or not weights:
        return []
    best, choice = [0.0] * len(bounds), [None] * len(bounds)
    for j in range(1, len(bounds)):
        best[j] = best[j - 1]
        for i, kind, names in found.get(j, ()):
            score = best[i] + sum(weights.get(n, 0.0) for n in names)
            if score > best[j]:
                best[j], choice[j] = score, (i, kind)
    out, j = [], len(bounds) - 1
    while j > 0:
        if choice[j] is None:
            j -= 1
        else:
            i, kind = choice[j]
            out.append((bounds[i], bounds[j], kind))
            j = i
    return out[::-1]


def added_spans(text: str, base: list[Span], weights: Weights) -> list[Span]:
    """What the field finds beside the base spans."""
    out = []
    for start, end in windows(text):
        for s, e, kind in decode(text[start:end], weights):
            s, e = s + start, e + start
            if all(e <= b or s >= f for b, f, _ in base):
                out.append((s, e, kind))
    return out


# --- training ---------------------------------------------------------------------------------

def _gradient(bounds: list[int], found: dict, gold: list[Span], weights: Weights, into: Weights) -> None:
    """Adds observed minus expected feature counts of one window."""
    score = {(i, j, k): sum(weights.get(n, 0.0) for n in names) for j, parts in found.items() for i, k, names in parts}
    count = len(bounds)
    ahead, back = [0.0] * count, [0.0] * count
    for j in range(1, count):
        terms = [ahead[j - 1]] + [ahead[i] + score[i, j, k] for i, k, _ in found.get(j, ())]
        top = max(terms)
        ahead[j] = top + math.log(sum(math.exp(t - top) for t in terms))
    starts = defaultdict(list)
    for j, parts in found.items():
        for i, k, _ in parts:
            starts[i].append((j, k))
    for i in range(count - 2, -1, -1):
        terms = [back[i + 1]] + [back[j] + score[i, j, k] for j, k in starts.get(i, ())]
        top = max(terms)
        back[i] = top + math.log(sum(math.exp(t - top) for t in terms))
    wanted = set(gold)
    for j, parts in found.items():
        for i, k, names in parts:
            step = ((bounds[i], bounds[j], k) in wanted) - math.exp(ahead[i] + score[i, j, k] + back[j] - ahead[-1])
            for n in names:
                into[n] += step


def rewritten(text: str, gold: list[Span]) -> list[tuple[str, list[Span]]]:
    """The window with its only span written in other ways, or replaced by numbers of no kind."""
    if len(gold) != 1:
        return []
    start, end, kind = gold[0]
    span, digits = text[start:end], digits_of(text[start:end])
    others, decoys = [], []
    if kind == "card":
        others = [sep.join(re.findall(".{1,4}", digits)) for sep in ".- "]
    elif kind == "phone" and len(digits) > 10:
        others = [f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}"]
        decoys = [f"20{digits[-2:]}-0{digits[-3]}-1{digits[-4]} 1{digits[-5]}:30", digits[-8:], f"{digits[-6:-4]} {digits[-4:-2]} {digits[-2:]} {digits[:3]}"]
    elif kind == "email":
        name, host = span.split("@")
        others = [f"{name} {at} {host.replace('.', dot)}" for at, dot in (("(at)", "."), ("[at]", " [dot] "), ("(at)", " (dot) "))]
        others += [f"{name} (at) mail (dot) {host.replace('.', ' (dot) ')}", f"{name} [at] mail.{host}"]
    return [(text[:start] + o + text[end:], [(start, start + len(o), kind)]) for o in others] + [(text[:start] + o + text[end:], []) for o in decoys]


def train(samples: list[tuple[str, list[Span]]]) -> Weights:
    """Weights by gradient steps on the mean conditional log likelihood, with decay. No samples: no weights."""
    data = [(*segments(t), g) for text, gold in samples for t, g in [(text, gold), *rewritten(text, gold)]]
    data = [d for d in data if d[1]]
    weights: Weights = defaultdict(float)
    squares: Weights = defaultdict(float)
    for _ in range(ROUNDS if data else 0):
        step: Weights = defaultdict(float)
        for bounds, found, gold in data:
            _gradient(bounds, found, gold, weights, step)
        for name, g in step.items():
            g = g / len(data) - DECAY * weights[name] / 10
            squares[name] += g * g
            weights[name] += RATE * g / math.sqrt(squares[name] + 1e-12)
    return dict(weights)


def _window_batches(batches):
    for part in pieces(batches, "text"):
        out = []
        for text in part.column("text").to_pylist():
            text = text or ""
            found = windows(text)
            base = base_spans(text) if found else []
            for start, end in found:
                inside = [(s - start, e - start, k) for s, e, k in base if start <= s and e <= end]
                out.append((text[start:end], " ".join(f"{s}:{e}:{k}" for s, e, k in inside)))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.string())] * 2, names=["window", "gold"])


def learned(docs: DataFrame, docs_bound: int = TRAIN_DOCS, windows_bound: int = TRAIN_WINDOWS) -> Weights:
    """Weights from a bounded sample: about ``docs_bound`` documents by a hash of text, windows with most and least to learn alike."""
    share = min(1.0, docs_bound / max(1, docs.count()))
    some = docs.select("text").where(F.pmod(F.xxhash64("text", F.lit("train")), 1 << 20) < share * (1 << 20))
    found = some.mapInArrow(_window_batches, "window string, gold string").distinct()
    rows = [r for kind in (F.col("gold") != "", F.col("gold") == "") for r in found.where(kind & (F.length("window") < 400)).orderBy(F.xxhash64("window"), "window").limit(windows_bound // 2).collect()]
    return train([(r.window, [(int(s), int(e), k) for s, e, k in (x.split(":") for x in r.gold.split())]) for r in rows])


# --- queries ----------------------------------------------------------------------------------

def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (KINDS.index(x[2]), x[0])))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of base spans by kind, their digest, and all spans with the added ones.

    Null and empty texts have none. Repeated rows stay; other columns are ignored.
    """
    def run(batches):
        for part in pieces(batches, "text"):
            rows = []
            for text in part.column("text").to_pylist():
                base = base_spans(text or "")
                counts = [sum(k == kind for _, _, k in base) for kind in KINDS]
                rows.append((*counts, sha256_hex(_joined(base).encode()), _joined(base + added_spans(text or "", base, weights))))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, zip(*rows, strict=True))], names=[x.split()[0] for x in FOUND.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FOUND)


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find(docs, learned(docs))


def masked(text: str, spans: list[Span]) -> str:
    out, end = [], 0
    for s, e, kind in sorted(spans):
        if e <= end:
            continue
        out += [text[end:max(s, end)], f"<{kind}>"]
        end = e
    return "".join([*out, text[end:]])


def mask_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span is replaced by the name of its kind; ``n_chars`` follows."""
    weights = learned(docs)
    place = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for part in pieces(batches, "text"):
            texts = part.column("text").to_pylist()
            clean = [t if t is None else masked(t, (base := base_spans(t)) + added_spans(t, base, weights)) for t in texts]
            part = part.set_column(place, part.schema.field(place), pa.array(clean, part.schema.field(place).type))
            if count is not None:
                field = part.schema.field(count)
                part = part.set_column(count, field, pa.array([None if t is None else len(t) for t in clean], field.type))
            yield part

    return docs.mapInArrow(run, docs.schema)


QUERIES = {"op1_personal_data": op1_personal_data}
