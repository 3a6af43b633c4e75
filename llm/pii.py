"""Personal data: fixed patterns, and further spans by weak supervision."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of the fixed patterns, in their order, then the kinds of further spans.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "iban", "ssn", "mac", "name", "address")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        n = int(x) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: a local part back to the last match or @, a domain forward."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", low)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Each four numbers of a dotted chain, all at most 255."""
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        at, numbers = chain.start(), chain.group().split(".")
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str | None) -> list[Span]:
    """The fixed patterns' spans in code points, by kind, then start.

    Matches are leftmost and don't overlap within a kind; one that fails its check
    is dropped. All patterns take time in proportion to the text.
    """
    text = text or ""
    found = [("email", *x) for x in _emails(text)]
    if not any(map(text.__contains__, "0123456789")):
        return found
    found += [("ip", *x) for x in _ips(text)]
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, match.group())) <= 15:
                found.append(("phone", *match.span()))
    return found


# Signs that a candidate of a further kind is looked up by, and words
# before it that speak for it.
_SECRET_WORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key")
_CUES = {
    "secret": frozenset((*_SECRET_WORDS, "key", "login", "credentials")),
    "iban": frozenset(("iban", "account", "bank", "konto", "compte", "cuenta")),
    "ssn": frozenset(("ssn", "social", "security")),
    "mac": frozenset(("mac", "device", "ethernet", "address")),
    "phone": frozenset(("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono")),
    "ip": frozenset(("ip", "host", "server", "address")),
    "card": frozenset(("card", "visa", "credit", "karte", "carte", "tarjeta")),
    "email": frozenset(("mail", "email", "contact", "write")),
    "name": frozenset(
        "name named called dear regards sincerely signed author patient contact "
        "heißt heiße namens liebe lieber grüße nom appelle cher chère signé llamo llama "
        "nombre estimado estimada firmado".split()
    ),
    "address": frozenset(
        "address lives live living resides ship deliver office wohnt wohne adresse "
        "anschrift habite demeure dirección domicilio vive vivo".split()
    ),
}
_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())

# Frequent given names that are no other common words, forms of
# address, and words for kinds of streets.
_GIVEN = frozenset(
    "Aaron Adam Alberto Alejandro Alexander Alfred Alice Amanda Amélie Andrea Andreas "
    "Andrew Angela Anita Annette Anthony Antonio Antoine Ashley Barbara Beatriz Benjamin "
    "Bernard Bernd Bettina Birgit Brian Brigitte Bruno Carlos Carmen Caroline Catherine "
    "Cécile Charlotte Christian Christina Christine Christopher Claire Claudia Cynthia "
    "Daniel Daniela David Deborah Dennis Diego Dieter Donald Dorothy Edward Elena "
    "Elisabeth Elizabeth Emily Emma Enrique Eric Esther Eva Fernando Florian Francisco "
    "François Françoise Frank Franz Frédéric Gabriel Gary George Gerhard Gloria Gregory "
    "Guillaume Hans Heather Heinz Helen Helga Helmut Hélène Inés Ingrid Isabel Isabelle "
    "Jacob Jacques James Javier Jean Jeffrey Jennifer Jessica Joachim Johannes John "
    "Jonathan Jorge José Joseph Joshua Juan Juliette Julie Jürgen Karen Karin Katharina "
    "Kathleen Kenneth Kevin Kimberly Klaus Larry Laura Laurent Linda Lisa Louise Lucía "
    "Luis Manfred Manuel Margaret María Maria Marie Martin Martina Mary Matthew Matthias "
    "Mercedes Michael Michel Michelle Miguel Monika Monique Nancy Nathalie Nicholas "
    "Nicolas Nicole Olivier Pablo Pamela Patricia Patrick Paul Paula Pedro Peter Philippe "
    "Pierre Pilar Rachel Rafael Rebecca Renate Richard Robert Roberto Ronald Rosario "
    "Russell Ruth Sabine Samantha Samuel Sandra Sarah Sébastien Sergio Sharon Silvia "
    "Sophie Stefan Stephanie Stephen Steven Susan Susanne Sylvie Teresa Thomas Timothy "
    "Ursula Uwe Valérie Véronique Virginia Walter Werner William Wolfgang".split()
)
_TITLES = (
    "Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Herrn", "Frau", "Monsieur", "Madame", "Mme",
    "Señor", "Señora", "Sr", "Sra", "Don", "Doña",
)
_STREETS = (
    "Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Ln", "Drive", "Boulevard",
    "Blvd", "Court", "Way", "Terrace", "Square",
)
#: What follows a given name or a title without being a name.
_NO_NAMES = frozenset(
    (*_STREETS, *_TITLES, "The", "And", "Or", "In", "On", "At", "Of", "To", "Is", "Was",
     "He", "She", "It", "They", "Der", "Die", "Das", "Und", "Le", "La", "Les", "Et", "El",
     "Los", "Las", "Un", "Una", "January", "June", "July", "August", "Monday", "Friday")
)

_UPPER, _LOWER = "A-Z\u00c0-\u00d6\u00d8-\u00de", "a-z\u00df-\u00f6\u00f8-\u00ff"
_NAMED = f"(?:[{_UPPER}]['\u2019])?[{_UPPER}][{_LOWER}]+(?:-[{_UPPER}][{_LOWER}]+)?"
_FULL_NAME = re.compile(rf"(?<!\w)({_NAMED})(?: [{_UPPER}]\.)? ({_NAMED})(?!\w)")
_TITLED = re.compile(rf"(?<!\w)(?:{'|'.join(_TITLES)})\.? ({_NAMED}(?: {_NAMED})?)(?!\w)")
#: House numbers before and behind the name of a street.
_ADDRESSES = (
    (" ", re.compile(rf"(?<![\w.])[0-9]{{1,5}} (?:{_NAMED} ){{1,3}}(?:{'|'.join(_STREETS)})(?!\w)")),
    ("tr", re.compile(rf"(?<!\w)[{_UPPER}][{_LOWER}]*str(?:aße|asse|\.) [0-9]{{1,4}}[a-z]?(?!\w)")),
    ("weg ", re.compile(rf"(?<!\w)[{_UPPER}][{_LOWER}]*weg [0-9]{{1,4}}[a-z]?(?!\w)")),
    ("platz ", re.compile(rf"(?<!\w)[{_UPPER}][{_LOWER}]*platz [0-9]{{1,4}}[a-z]?(?!\w)")),
    ("rue ", re.compile(rf"(?<![\w.])[0-9]{{1,4}},? rue (?:de |du |des |la |le |l'){{0,3}}{_NAMED}(?!\w)")),
    ("venue ", re.compile(rf"(?<![\w.])[0-9]{{1,4}},? avenue (?:de |du |des |la |le |l'){{0,3}}{_NAMED}(?!\w)")),
    ("alle ", re.compile(rf"(?<!\w)[Cc]alle (?:de |del |la |los |las ){{0,3}}{_NAMED},? [0-9]{{1,4}}(?!\w)")),
    ("venida ", re.compile(rf"(?<!\w)[Aa]venida (?:de |del |la |los |las ){{0,3}}{_NAMED},? [0-9]{{1,4}}(?!\w)")),
)

_VALUE = re.compile(r"\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9+/_.-]{6,})")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_MAC = re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_WORD = re.compile(r"[^\W\d_]+")


def candidates(text: str) -> list[Span]:
    """Places that may be personal data beside the fixed patterns."""
    found: list[Span] = []
    lowered = text.lower()
    if len(lowered) != len(text):  # some signs become two; places must agree
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for sign in _SECRET_WORDS:
        at = lowered.find(sign)
        while at >= 0:
            if value := _VALUE.match(text, at + len(sign)):
                found.append(("secret", *value.span(1)))
            at = lowered.find(sign, at + len(sign))
    if any(map(text.__contains__, "0123456789")):
        found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
        if "-" in text:
            found += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        if ":" in text or "-" in text:
            found += [("mac", *m.span()) for m in _MAC.finditer(text)]
        found += [("phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
        for sign, address in _ADDRESSES:
            if sign in text:
                found += [("address", *m.span()) for m in address.finditer(text)]
    found += [("name", *m.span()) for m in _FULL_NAME.finditer(text) if m[1].partition("-")[0] in _GIVEN]
    if any(map(text.__contains__, _TITLES)):
        found += [("name", *m.span(1)) for m in _TITLED.finditer(text)]
    return sorted(set(found), key=lambda s: (s[1], -s[2], KINDS.index(s[0])))


def _iban_holds(value: str) -> bool:
    value = value.replace(" ", "")
    turned = "".join(str(int(c, 36)) for c in value[4:] + value[:4])
    return int(turned) % 97 == 1


#: Labelers. Each says 1 for personal, 0 for not, or 2 for no opinion.
LABELERS = ("shape", "check", "gazetteer", "context", "mixture", "edges")
#: How often each says 0 where it has an opinion of what is not personal, and 1 of what
#: is, to start with.
START = (0.6, 0.99, 0.77, 0.77, 0.6, 0.77)
#: A sum of digits or an impossible value is a fact: what it tells is not estimated.
FACT = LABELERS.index("check")


def votes(text: str, span: Span) -> tuple[int, ...]:
    """What each labeler says about a candidate."""
    kind, start, end = span
    value = text[start:end]
    digits = sum(map(str.isdigit, value))
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])][-4:]
    sized = {"secret": len(value) >= 12, "phone": digits >= 10, "iban": 15 <= len(value) <= 42}
    shape = int(sized.get(kind, True))
    check, gazetteer = 2, 2
    if kind == "iban":
        check = int(_iban_holds(value))
        gazetteer = int(value[:2] in _COUNTRIES)
    elif kind == "ssn":
        check = int(value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00")
    elif kind == "secret":
        gazetteer = int(value.lower() not in ("password", "secret", "changeme", "example", "none"))
    elif kind == "phone":
        gazetteer = int(value.strip("(")[0] not in "01")
    elif kind == "name":
        words = value.split()
        check = 0 if _NO_NAMES.intersection(words) else 2
        gazetteer = 1 if words[0].partition("-")[0] in _GIVEN else 2
    elif kind == "address":
        number = int("".join(filter(str.isdigit, value)))
        check = 0 if number == 0 or 1900 <= number < 2100 else 2  # a year is no house
        gazetteer = 1
    context = 1 if _CUES[kind].intersection(before) else 2
    kinds = (any(map(str.isalpha, value)), digits > 0, len(set(value)) > 4)
    mixture = int(all(kinds)) if kind == "secret" else int(kinds[2])
    if kind == "name":
        before = [w.rstrip(".") for w in text[max(0, start - 12) : start].split()][-1:]
        context = 1 if context == 1 or before and before[0] in _TITLES else 2
        mixture = int(value.istitle() or len(value.split()) > 1)
    beside = text[max(0, start - 1) : start] + text[end : end + 1]
    edges = 0 if any(map(str.isalnum, beside)) else 2
    return shape, check, gazetteer, context, mixture, edges


def pattern(text: str, span: Span) -> tuple[int, ...]:
    """A candidate's features: kind, size in powers of two, share of digits, votes."""
    kind, start, end = span
    digits = sum(map(str.isdigit, text[start:end]))
    size = min((end - start).bit_length(), 7)
    return KINDS.index(kind), size, 4 * digits // (end - start), *votes(text, span)


def _one_hot(rows: np.ndarray) -> np.ndarray:
    sizes = (len(KINDS), 8, 5, *([3] * len(LABELERS)))
    return np.hstack([np.eye(n)[rows[:, i]] for i, n in enumerate(sizes)])


@dataclass
class SpanModel:
    """Labelers' reliabilities, and a classifier trained on what they agree on."""

    says: np.ndarray = field(default_factory=lambda: np.zeros((2, len(LABELERS), 3)))
    weights: np.ndarray | None = None
    bias: float = 0.0

    @classmethod
    def fit(cls, patterns: dict[tuple[int, ...], int], steps: int = 30) -> SpanModel:
        """Expectation-maximisation over counts of patterns, then logistic regression.

        A class starts from ``START``; a labeler's reliability is how often it says
        what for each class where it has an opinion, but for that of facts. Silence
        says nothing.
        """
        right = np.array(START)
        start = np.stack([[right, 1 - right], [1 - right, right]]).transpose(0, 2, 1)
        start = np.dstack([start, np.ones((2, len(LABELERS)))])
        says = start.copy()
        if not patterns:
            return cls(says)
        rows = np.array(sorted(patterns))
        counts = np.array([patterns[tuple(r)] for r in rows.tolist()], float)
        heard, prior = rows[:, 3:], 0.5
        for _ in range(steps):
            picked = [np.log(says[c][np.arange(len(LABELERS)), heard]).sum(1) for c in (0, 1)]
            odds = picked[1] - picked[0] + np.log(prior / (1 - prior))
            likely = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            prior = float(np.clip((likely @ counts + 1) / (counts.sum() + 2), 0.05, 0.95))
            for c, share in enumerate(((1 - likely) * counts, likely * counts)):
                for value in range(2):
                    # The start counts as much as ten candidates.
                    seen = share @ (heard == value) + 10 * start[c, :, value]
                    says[c, :, value] = seen / (share @ (heard < 2) + 10)
            says[:, FACT] = start[:, FACT]
        x, weight = _one_hot(rows), counts / counts.sum()
        weights, bias = np.zeros(x.shape[1]), 0.0
        for _ in range(500):
            error = weight * (1 / (1 + np.exp(-(x @ weights + bias))) - likely)
            weights -= 1.0 * (x.T @ error + 1e-4 * weights)
            bias -= 1.0 * error.sum()
        return cls(says, weights, float(bias))

    def chance(self, row: tuple[int, ...]) -> float:
        if self.weights is None:
            return 0.0
        odds = float(_one_hot(np.array([row]))[0] @ self.weights) + self.bias
        return 1 / (1 + float(np.exp(-odds)))


def fit(docs: DataFrame) -> SpanModel:
    """A model from the candidates in all of ``docs`` (text, ...).

    Candidates alike in all features are one count, so few numbers reach the driver
    however many there are.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[tuple[int, ...]] = Counter()
            for text in batch.column(0).to_pylist():
                found.update(pattern(text, s) for s in candidates(text or ""))
            columns = {"pattern": [list(p) for p in found], "n": list(found.values())}
            kinds = pa.schema([("pattern", pa.list_(pa.int32())), ("n", pa.int64())])
            yield pa.RecordBatch.from_pydict(columns, kinds)

    found = docs.select("text").mapInArrow(tally, "pattern array<int>, n long")
    found = found.groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    return SpanModel.fit({tuple(r["pattern"]): r["n"] for r in found})


def further_spans(
    text: str, base: list[Span], model: SpanModel, known: dict[tuple, float]
) -> list[Span]:
    """Candidates that the model takes, without overlap with others or base spans."""
    out: list[Span] = []
    taken = sorted((s, e) for _, s, e in base)
    for span in candidates(text):
        row = pattern(text, span)
        if row not in known:
            known[row] = model.chance(row)
        if known[row] < 0.5 or any(s < span[2] and span[1] < e for s, e in taken):
            continue
        out.append(span)
        taken.append(span[1:])
    return out


FOUND = "base array<string>, spans array<string>, masked string"


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span as its kind in brackets; overlaps are one place."""
    out, last = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def found(model: SpanModel) -> Column:
    """A struct (base, spans, masked) for the column ``text``.

    base and spans hold ``kind:start:end`` by kind, then start, in code points with
    exclusive ends: spans of the fixed patterns, and these with the further ones.
    masked is the text with all of them hidden. A null text is like an empty one.
    Rows are searched one by one, so repeated rows, null ids and other columns make
    no difference; an empty table stays empty.
    """

    def search(batches):
        known: dict[tuple, float] = {}
        shown = "{}:{}:{}".format
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                base = base_spans(text)
                spans = base + further_spans(text, base, model, known)
                spans.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                rows.append(([shown(*s) for s in base], [shown(*s) for s in spans], mask(text, spans)))
            yield pd.DataFrame(rows, columns=["base", "spans", "masked"])

    search.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(search, FOUND)("text")
