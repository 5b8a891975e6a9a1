"""Personal data: base patterns, and further spans by weak supervision.

1. Every text is scanned whole. The base patterns (email, ip, card, phone) are plain
   matches and always stay. Wider patterns give candidates of further kinds: addresses
   spelled out, telephone numbers without a plus, social security and bank account
   numbers, long IP addresses, names, streets and dates of birth.
2. Labelers vote on each span for, against or not at all: regex (shape, check digits),
   gazetteer (given names, domains, countries, places), context (cue words around,
   other personal data nearby, rows of figures). None is trusted as such.
3. Expectation-maximisation over the counts of all vote patterns of the corpus estimates
   how often each labeler votes how for true and for false spans, and how many spans of a
   kind are true. A pattern and its count is all that leaves the tasks; there are at most
   ``kinds * 3**labelers`` of them.
4. The probabilities train a logistic classifier on votes, shape and surrounding words of
   the spans, on at most about ``SAMPLE`` spans chosen by a hash; it decides on every
   candidate of the whole corpus.

Texts are read once; what is kept of them are the spans. Each row is handled on its own
and nothing is shuffled but counts and the sample. A null text counts as empty, a null id
stays, repeated rows give repeated results, and a table without spans has a model that
adds none. The time for a text grows with its length. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import stored

# The kinds, base ones first, in report order.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "ip6", "mail", "birth", "street", "tel", "name")
LABELERS = ("shape", "checksum", "gazetteer", "cue", "company", "figures")

BUCKETS = 1 << 16
SAMPLE = 20_000  # bound of the spans that the classifier is fitted on, as an expectation
KEEP_FROM = 0.6
AROUND = 48  # characters before and after a span that count as its context
NEAR = 120  # characters within which other personal data lend support

# The base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match that fails at the start of a run of digits fails inside it, too.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The wider patterns; all repeats are bounded. Each begins with a plain class, or is looked for
# around a mark in its middle, which lets the search skip to it; what must not come before is asked then.
UPPER, LOWER = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
WAYS = "Street|St|Avenue|Ave|Road|Rd|Lane|Drive|Boulevard|Court|Square|Way"
WIDER = {
    "iban": [re.compile(r"[A-Z][A-Z](?<!\w..)[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)")],
    "ssn": [re.compile(r"[0-9](?<![\w.-].)[0-9]{2}-[0-9]{2}-[0-9]{4}(?![\w-])")],
    "birth": [re.compile(r"[0-9](?<![\w./-].)(?:[0-9]?[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|[0-9]{3}-[0-9]{2}-[0-9]{2})(?![\w/-])")],
    "street": [
        re.compile(rf"[0-9](?<!\w.)[0-9]{{0,4}}\x20(?:[{UPPER}][{LOWER}]{{1,20}}\x20){{1,3}}(?:{WAYS})(?!\w)"),
        re.compile(rf"[0-9](?<!\w.)[0-9]{{0,3}},?\x20(?:rue|avenue|boulevard|place)(?:\x20(?:de|du|des|la|le)){{0,2}}\x20[{UPPER}][{LOWER}]{{1,20}}(?!\w)"),
        re.compile(rf"(?:Calle|Avenida|Plaza)(?:\x20(?:de|del|la)){{0,2}}\x20[{UPPER}][{LOWER}]{{1,20}},?\x20[0-9]{{1,4}}(?!\w)"),
    ],
    "tel": [re.compile(r"[(0-9](?<![\w+(.:/-].)(?:(?<=\()[0-9]{2,5}\)\x20?|(?<=[0-9])[0-9]{1,4}[\x20./-])[0-9]{2,4}(?:[\x20.-][0-9]{2,5}){1,3}(?![\w:/-]|\.[0-9])")],
    "name": [re.compile(rf"[{UPPER}](?<!\w.)[{LOWER}]{{1,20}}(?:-[{UPPER}][{LOWER}]{{1,20}})?\x20(?:[{UPPER}]\.\x20)?[{UPPER}][{LOWER}]{{1,24}}(?:-[{UPPER}][{LOWER}]{{1,24}})?(?!\w)")],
}
COLONS = re.compile(r":(?:[0-9A-Fa-f]{1,4}:|:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])")
AT = re.compile(r"\([Aa][Tt]\)|\[[Aa][Tt]\]|\x20[Aa][Tt]\x20")
DOT = r"\([Dd][Oo][Tt]\)|\[[Dd][Oo][Tt]\]|\x20[Dd][Oo][Tt]\x20"
SPELLED = re.compile(rf"\x20?[A-Za-z0-9-]{{1,63}}(?:\x20?(?:{DOT}|\.)\x20?[A-Za-z0-9-]{{2,24}}){{1,3}}(?!\w)")
ENDING = re.compile(r"(?:straße|strasse|weg|platz|allee|gasse)\x20[0-9]{1,4}(?!\w)")
HEX = frozenset("0123456789abcdefABCDEF")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzäöüß")

# Gazetteers.
GIVEN = frozenset(
    """Adam Alejandro Alexander Alice Amanda Ana Andrea Andreas Andrew Angela Anna Anne Anthony Antoine Antonio Barbara Ben
    Benjamin Brian Camille Carlos Carmen Carol Caroline Catherine Charles Charlotte Christian Christine Christopher Claire Claudia
    Daniel David Diana Diego Dominik Edward Elena Elizabeth Emily Emma Eric Eva Felix Fernando Florian Francisco François Frank
    George Hannah Hans Helen Henry Hugo Isabel Jack Jacob James Jan Jane Javier Jean Jennifer Jessica Joan Johannes John Jonas
    Jonathan Jorge Joseph José Juan Julia Julie Karen Karl Katharina Kevin Laura Lena Linda Lisa Louis Lucas Lucía Luis Léa Manuel
    Margaret Maria Marie Mark Martin Mary María Matthew Maximilian Mia Michael Miguel Monica Nancy Nicolas Olivia Pablo Patricia
    Paul Pedro Peter Philip Philippe Pierre Rachel Richard Robert Rosa Ruth Samuel Sandra Sara Sarah Sofía Sophie Stefan Stephen
    Steven Susan Sébastien Thomas Ursula Victor William Wolfgang""".split()
)
NOT_NAMES = frozenset(
    """January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday
    Saturday Sunday North South East West New Old Great Saint United Royal The This That These Those When Where Chapter Figure
    Section Street Avenue University College Bank River Lake Park City Museum Airport Hospital Inc Ltd Corporation""".split()
)
DOMAINS = frozenset("com org net edu gov info biz io co uk de fr es it nl be ch at eu us ca au jp cn in br ru se no dk fi pl pt".split())
# Country and whole length of a bank account number.
IBAN = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28, "IE": 22}
IBAN |= {"IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24}
CUES = {
    "email": "mail email e-mail contact write reach kontakt correo courriel",
    "ip": "ip address host server login client addr adresse from",
    "card": "card visa mastercard credit payment paid account karte carte tarjeta",
    "phone": "phone call tel telephone mobile cell fax contact whatsapp telefon téléphone teléfono",
    "iban": "iban account bank transfer konto kontonummer bic swift compte cuenta",
    "ssn": "ssn social security tax taxpayer",
    "ip6": "ip ipv6 address host server login client addr adresse from",
    "mail": "mail email e-mail contact write reach kontakt correo courriel",
    "birth": "born birth birthday dob birthdate geboren geburtsdatum né née nacido nacida",
    "street": "address live lives living resides home street ship adresse wohnt anschrift habite dirección domicilio vive",
    "tel": "phone call tel telephone mobile cell fax contact whatsapp telefon téléphone teléfono",
    "name": "name named mr mrs ms dr dear herr frau monsieur madame mme señor señora signed sincerely regards patient client employee customer",
}
CUES = {kind: frozenset(words.split()) for kind, words in CUES.items()}
COUNTER = frozenset(
    """isbn issn version ver v page pages pp vol volume no. part model order invoice figure fig table chapter section paragraph
    serial sku article item score ratio equation rfc doi published released issued dated kapitel seite bestellung rechnung
    commande facture pedido factura""".split()
)
WORD = re.compile(r"[^\s,;:()\[\]\"'«»<>=]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The email pattern, around every @: a run of local characters is looked at once."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return found


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, unordered."""
    spans = [(a, 0, b) for a, b in emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return spans


def is_date(text: str) -> bool:
    a, b, c = (int(x) for x in re.split(r"[./-]", text))
    return 1 <= (b if a > 31 else max(1, min(a, b))) <= 12 and 1 <= (c if a > 31 else max(a, b)) <= 31


class Context:
    """A text with its words before and after a place."""

    def __init__(self, text: str):
        self.text = text

    def before(self, start: int) -> list[str]:
        return [w.lower() for w in WORD.findall(self.text[max(0, start - AROUND) : start])][-5:]

    def after(self, end: int) -> list[str]:
        return [w.lower() for w in WORD.findall(self.text[end : end + AROUND])][:3]


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the wider patterns that overlap nothing taken before them; specific kinds go first."""
    starts, ends = [], []
    for a, b in merged((s, e) for s, _, e in taken):
        starts.append(a)
        ends.append(b)

    def free(a: int, b: int) -> bool:
        i = bisect_right(starts, a)
        return (i == 0 or ends[i - 1] <= a) and (i == len(starts) or starts[i] >= b)

    found = []
    for number, kind in enumerate(KINDS[len(BASE) :], len(BASE)):
        for a, b in sorted(wider(kind, text)):
            if plausible(kind, text[a:b], text, a) and free(a, b):
                i = bisect_left(starts, a)
                starts.insert(i, a)
                ends.insert(i, b)
                found.append((a, number, b))
    return found


def back(text: str, at: int, allowed: frozenset, most: int) -> int:
    """Where the run of allowed characters that ends at ``at`` begins, at most so many before."""
    start = at
    while start > 0 and at - start < most and text[start - 1] in allowed:
        start -= 1
    return start


def wider(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the matches of a further kind."""
    for pattern in WIDER.get(kind, ()):
        for m in pattern.finditer(text):
            yield m.span()
    if kind == "ip6":
        for m in COLONS.finditer(text):
            start = back(text, m.start(), HEX, 4)
            if not (start and (text[start - 1].isalnum() or text[start - 1] in "_:")):
                yield start, m.end()
    elif kind == "mail":
        for m in AT.finditer(text):
            end = m.start() - (text[m.start() - 1 : m.start()] == " ")
            start = back(text, end, LOCAL, 64)
            if start < end and (rest := SPELLED.match(text, m.end())):
                yield start, rest.end()
    elif kind == "street":
        for m in ENDING.finditer(text):
            start = back(text, m.start(), LETTERS, 20) - 1
            if start >= 0 and m.start() - start > 2 and text[start].isupper() and not text[max(0, start - 1) : start].isalnum():
                yield start, m.end()


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def plausible(kind: str, span: str, text: str, start: int) -> bool:
    """Whether a match is worth a vote at all."""
    if kind == "tel":
        return 9 <= len(digits_of(span)) <= 12
    if kind == "ip6":
        return span.count(":") >= 3 and (span.count(":") == 7 or "::" in span)
    if kind == "birth":
        return is_date(span)
    if kind == "mail":
        return bool(re.search(rf"{DOT}|\([Aa][Tt]\)|\[[Aa][Tt]\]", span))
    if kind == "name":
        first = re.split(r"[ -]", span)[0]
        if first in GIVEN:
            return True
        words = WORD.findall(text[max(0, start - 16) : start])
        return bool(words) and words[-1].lower().rstrip(".") in CUES["name"]
    return True


def votes(kind: str, span: str, context: Context, start: int, end: int, company: bool) -> tuple[int, ...]:
    """One vote per labeler: 1 for personal data, -1 against, 0 for none."""
    digits = digits_of(span)
    shape = checksum = gazetteer = 0
    if kind in BASE:
        shape, checksum = 1, 1 if kind == "card" else 0
        if kind == "ip" and span.startswith(("0.", "10.", "127.", "192.168.")):
            gazetteer = -1
        if kind == "email":
            gazetteer = 1 if span.rsplit(".", 1)[1].lower() in DOMAINS else -1
    elif kind == "iban":
        bare = span.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in bare[4:] + bare[:4])
        checksum = 1 if int(number) % 97 == 1 else -1
        gazetteer = 1 if bare[:2] in IBAN else -1
        shape = 1 if len(bare) == IBAN.get(bare[:2]) else -1
    elif kind == "ssn":
        valid = digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
        shape = 1 if valid else -1
    elif kind == "mail":
        shape = 1 if re.search(r"\((?:at|dot)\)|\[(?:at|dot)\]", span, re.IGNORECASE) else 0
        gazetteer = 1 if re.split(r"\W+", span.lower())[-1] in DOMAINS else -1
    elif kind == "birth":
        year = int(re.search(r"(?:19|20)[0-9]{2}", span)[0])
        shape = 0 if 1920 <= year <= 2012 else -1
    elif kind == "street":
        shape = 1
        gazetteer = -1 if len(digits) > 4 else 0
    elif kind == "tel":
        shape = 1 if re.fullmatch(r"\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}|0[0-9]{2,4}[ /-][0-9 -]{5,11}", span) else -1
    elif kind == "name":
        first, *_, last = re.split(r"[ -]", span)
        gazetteer = -1 if first in NOT_NAMES or last in NOT_NAMES else 1 if first in GIVEN else 0
    before, after = context.before(start), context.after(end)
    words = {w.rstrip(".") for w in before}
    cue = 1 if words & CUES[kind] else -1 if (words | set(before)) & COUNTER else 0
    if not cue and any(w in CUES[kind] for w in after):
        cue = 1
    near = context.text[max(0, start - AROUND) : start] + " " + context.text[end : end + AROUND]
    figures = -1 if sum(any(c.isdigit() for c in w) for w in near.split()) >= 4 else 0
    return shape, checksum, gazetteer, cue, 1 if company else 0, figures


def features(kind: str, span: str, given: tuple[int, ...], context: Context, start: int, end: int) -> list[int]:
    """Hashed traits of a span: its votes, its shape and the words around it."""
    form = re.sub(r"[0-9]+", "9", re.sub(rf"[{UPPER}][{LOWER}]+", "Aa", re.sub(rf"[{LOWER}]+", "a", span)))[:24]
    names = [kind, f"{kind} form {form}", f"{kind} size {len(span) // 4}"]
    names += [f"{labeler} {v}" for labeler, v in zip(LABELERS, given)] + [f"{kind} {labeler} {v}" for labeler, v in zip(LABELERS, given)]
    names += [f"{kind} before {w}" for w in context.before(start)[-3:]] + [f"{kind} after {w}" for w in context.after(end)]
    return sorted({zlib.crc32(n.encode("utf-8", "replace")) % BUCKETS for n in names})


def seen(text: str) -> list[tuple[int, int, int, str, list[int]]]:
    """(start, kind, end, votes, features) of every base span and candidate, by start and kind."""
    base = base_spans(text)
    spans = sorted(base + candidates(text, base))
    context, out = Context(text), []
    begins, reach = [s for s, _, _ in spans], 0
    for i, (start, kind, end) in enumerate(spans):
        name, span = KINDS[kind], text[start:end]
        company = (i > 0 and start - reach <= NEAR) or (bisect_left(begins, end + NEAR) - i > 1)
        reach = max(reach, end)
        given = votes(name, span, context, start, end, company)
        out.append((start, kind, end, "".join("-0+"[v + 1] for v in given), features(name, span, given, context, start, end)))
    return out


SPAN = "struct<start: int, kind: int, end: int, votes: string, features: array<int>>"


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: all base spans and candidates with their votes and features."""
    kind = docs.schema[id_col].dataType.simpleString()
    lists = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("votes", pa.string()), ("features", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(("start", "kind", "end", "votes", "features"), s)) for s in seen(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, lists)], ["id", "spans"])

    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, spans array<{SPAN}>")


@dataclass(frozen=True)
class Reliabilities:
    """What EM found: the share of true spans by kind, and P(vote | truth) by truth, kind, labeler and vote."""

    prior: np.ndarray  # by kind
    rates: np.ndarray  # [truth, kind, labeler, vote + 1]

    def posterior(self, kinds: np.ndarray, given: np.ndarray) -> np.ndarray:
        """P(true) of spans with the given votes (-1, 0, 1 as 0, 1, 2)."""
        place = np.arange(given.shape[1])
        log = np.log(self.rates)[:, kinds[:, None], place[None, :], given].sum(axis=2)
        gap = log[1] - log[0] + np.log(self.prior[kinds]) - np.log1p(-self.prior[kinds])
        return 1 / (1 + np.exp(-np.clip(gap, -35, 35)))


# Pseudo-counts of votes (against, none, for): labelers are taken to be better than chance before any data.
COUNTS = np.array([[10.0, 8.0, 2.0], [2.0, 8.0, 10.0]])  # false, true


def reliabilities(kinds: np.ndarray, given: np.ndarray, counts: np.ndarray, steps: int = 50) -> Reliabilities:
    """Expectation-maximisation over vote patterns and their counts; a labeler has rates of its own for each kind."""
    n, labelers = len(KINDS), given.shape[1]
    base = np.broadcast_to(COUNTS[:, None, None, :], (2, n, labelers, 3))
    model = Reliabilities(np.full(n, 0.5), base / COUNTS.sum(axis=1)[0])
    held = np.bincount(kinds, counts, minlength=n)
    for _ in range(steps):
        p = model.posterior(kinds, given)
        rates = base.copy()
        for labeler in range(labelers):
            cell = kinds * 3 + given[:, labeler]
            for truth, share in enumerate((1 - p, p)):
                rates[truth, :, labeler] += np.bincount(cell, share * counts, minlength=3 * n).reshape(n, 3)
        true = np.bincount(kinds, p * counts, minlength=n)
        model = Reliabilities((true + 2) / (held + 4), rates / rates.sum(axis=3, keepdims=True))
    return model


def fit(rows: list[list[int]], target: np.ndarray, steps: int = 300, l2: float = 1e-3) -> np.ndarray:
    """Logistic weights for soft targets, by Adam over all spans at once; the last weight is the bias."""
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    flat = np.concatenate([[*r, BUCKETS] for r in rows]).astype(np.int64)
    span = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    used, place = np.unique(flat, return_inverse=True)
    w, m, v = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(span, w[place], minlength=len(rows)), -35, 35)))
        grad = np.bincount(place, (p - target)[span], minlength=len(used)) / len(rows) + l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    weights[used] = w
    return weights


def codes_of(patterns: list[str]) -> np.ndarray:
    return np.array([["-0+".index(c) for c in p] for p in patterns], np.int64).reshape(len(patterns), len(LABELERS))


@dataclass(frozen=True)
class Model:
    labelers: Reliabilities
    weights: np.ndarray

    def probability(self, features: list[int]) -> float:
        score = self.weights[features].sum() + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(score, -35, 35))))


def train(spans: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the spans of a corpus; ``spans`` must be a written table, for the sample goes by places in it."""
    each = spans.select(F.explode("spans").alias("s"), F.monotonically_increasing_id().alias("at")).select("s.*", "at")
    patterns = each.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    if not patterns:
        return Model(reliabilities(np.zeros(0, np.int64), codes_of([]), np.zeros(0), 1), fit([], np.zeros(0)))
    counts = np.array([r["count"] for r in patterns], float)
    labelers = reliabilities(np.array([r["kind"] for r in patterns]), codes_of([r["votes"] for r in patterns]), counts)
    share = min(1.0, sample / counts.sum())
    place = F.pmod(F.xxhash64("at", "start", "kind"), F.lit(1 << 30))
    drawn = each.where(place < int(share * (1 << 30))).select("kind", "votes", "features").orderBy("kind", "votes", "features").collect()
    target = labelers.posterior(np.array([r["kind"] for r in drawn], np.int64), codes_of([r["votes"] for r in drawn]))
    return Model(labelers, fit([r["features"] for r in drawn], target))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def accepted(found: list, model: Model, keep_from: float = KEEP_FROM) -> list[tuple[int, int, int]]:
    """All base spans, and the candidates that the classifier takes."""
    return [(s, k, e) for s, k, e, _, f in found if k < len(BASE) or model.probability(f) >= keep_from]


RESULT = "n_email long, n_ip long, n_card long, n_phone long, n_more long, base_sha256 string, spans string"


def judged(spans: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts by base kind, a digest of the base spans, and all spans as ``kind:start:end``."""
    shared = spans.sparkSession.sparkContext.broadcast(model)
    kind = spans.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = []
            for found in batch.column("spans").to_pylist():
                kept = accepted([tuple(s.values()) for s in found], model)
                base = [s for s in kept if s[1] < len(BASE)]
                held = Counter(k for _, k, _ in base)
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*[held[k] for k in range(len(BASE))], len(kept) - len(base), digest, written(kept)))
            columns = list(zip(*rows)) or [[]] * 7
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 5 + [pa.string()] * 2)]
            names = ["n_email", "n_ip", "n_card", "n_phone", "n_more", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], [id_col, *names])

    return spans.mapInArrow(run, f"`{id_col}` {kind}, {RESULT}")


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The personal data of every document, by a model of this corpus."""
    spans = stored(scanned(docs, id_col, text_col), "spans")
    return judged(spans, train(spans), id_col)


def masked(text: str, model: Model, mark: str = "[{kind}]") -> str:
    out, at = [], 0
    for start, kind, end in accepted(seen(text), model):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark.format(kind=KINDS[kind])]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, text_col: str = "text", mark: str = "[{kind}]") -> DataFrame:
    """The same rows and columns with every span replaced by ``mark``; overlapping spans become one, of the first kind.

    A null text stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else masked(t, shared.value, mark) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
