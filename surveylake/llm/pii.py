"""Personal data in texts: fixed base patterns, and further spans by a linear-chain conditional random field.

The field labels tokens (runs of characters other than white space, without brackets, quotes and stops around
them) with begin and inside labels for the four kinds. Its features are word shapes: the classes of characters, lengths, prefix and
suffix, the shapes of the words around, and whether digits in a row pass the checksum of card numbers; it is trained on a small
labelled table, by default one made from the templates below, and decoded by Viterbi over batches of sequences in numpy.

A sequence is a maximal run of tokens that are at most `CONTEXT` tokens from one with a digit or an at sign; other tokens
have the outside label by definition. Base spans are always kept; a span of the field is added unless it
overlaps a base span, holds fewer digits than its kind needs, lacks the at sign of an email or the separators of an address, or is a card
that fails the checksum.

Defined results: a null or empty text has no spans; a repeated row has the same spans; an empty
table gives no rows; other columns are ignored. Work is linear in the text: no base pattern starts twice inside one run of its characters.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from surveylake.llm.words import pieces, raw_bytes, sums_between

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 2
FEATURE_BITS = 13
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
DIGITS_NEEDED = {"email": 0, "ip": 4, "card": 13, "phone": 9}

# Equal to the patterns of the base: a run of digits is matched from its first digit or, from a later one, not at all.
_IP = re.compile(r"(?<![0-9])([0-9]++)(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        # The next local part may begin right after this at sign, or after the match.
        end = found.end() if found else at + 1
        at = text.find("@", end)


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _small_part(part: str) -> bool:
    value = part.lstrip(".").lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind as listed."""
    spans = [(a, b, "email") for a, b in _emails(text)]
    spans += [(*m.span(), "ip") for m in _IP.finditer(text) if all(_small_part(g) for g in m.groups())]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            spans.append((*m.span(), "phone"))
    return in_order(spans)


def in_order(spans: Sequence[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- sequences and features

_TOKEN = re.compile(r"\S+")
_SIGNAL = re.compile(r"[0-9@]")
_OUTER = "()[]{}<>\"'`.,;:!?"


@dataclass
class Sequence_:
    tokens: list[str]
    spans: list[tuple[int, int]]


def _trimmed(token: str, start: int) -> tuple[str, int, int]:
    left = token.lstrip(_OUTER)
    begin = start + len(token) - len(left)
    core = left.rstrip(_OUTER)
    # A bracket that closes inside the token, or right after it, opens it: "(555)" and "(555)123".
    after = left[len(core) : len(core) + 1]
    if begin > start and token[begin - start - 1] == "(" and (")" in core or after == ")"):
        begin -= 1
        core = "(" + core + (")" if ")" not in core else "")
    return core, begin, begin + len(core)


def sequences(text: str) -> list[Sequence_]:
    """The runs of tokens around those with a digit or an at sign."""
    found: list[Sequence_] = []
    before: list[tuple[str, int, int]] = []  # up to CONTEXT tokens that no sequence holds yet
    current: Sequence_ | None = None
    left = 0
    for m in _TOKEN.finditer(text):
        token, start, end = _trimmed(m.group(), m.start())
        if _SIGNAL.search(token):
            if current is None:
                current = Sequence_([t for t, _, _ in before], [(a, b) for _, a, b in before])
                found.append(current)
            left, before = CONTEXT + 1, []
        if current is not None and left:
            current.tokens.append(token)
            current.spans.append((start, end))
            left -= 1
            if not left:
                current = None
        else:
            before = [*before, (token, start, end)][-CONTEXT:]
    return found


def shape(token: str) -> str:
    """Runs of the same class, with the length of digit runs: `(555)123-4567` is `(d3)d3-d4`."""
    out, i = [], 0
    while i < len(token) and len(out) < 24:
        c, j = token[i], i + 1
        if "0" <= c <= "9":
            while j < len(token) and "0" <= token[j] <= "9":
                j += 1
            out.append(f"d{min(j - i, 20)}")
        elif c.isalpha():
            upper = c.isupper()
            while j < len(token) and token[j].isalpha() and token[j].isupper() == upper:
                j += 1
            out.append("X" if upper else "x")
        else:
            out.append(c)
        i = j
    return "".join(out)


_NUMERIC = re.compile(r"[0-9][0-9./-]*")


def checksums(tokens: Sequence[str]) -> list[str]:
    """Per token, where it stands in a number of 13 to 19 digits that passes Luhn: `s` start, `m` inside, `e` end, `a` all of it.

    A number is a token, or some in a row, of digits with `.`, `/` or `-` between; `x` marks tokens of such lengths that pass nowhere.
    """
    digits = [_NOT_DIGIT.sub("", t) if _NUMERIC.fullmatch(t) else "" for t in tokens]
    marks: list[set[str]] = [set() for _ in tokens]
    for i in range(len(tokens)):
        joined, j = "", i
        while j < len(tokens) and digits[j] and len(joined) + len(digits[j]) <= 19:
            joined += digits[j]
            j += 1
            if len(joined) >= 13:
                good = _luhn(joined)
                for k in range(i, j):
                    place = "a" if j == i + 1 else "s" if k == i else "e" if k == j - 1 else "m"
                    marks[k].add(place if good else "x")
    return ["".join(sorted(m - {"x"} or m)) for m in marks]


def features(tokens: Sequence[str]) -> list[list[int]]:
    """Hashed feature numbers of each token."""
    shapes, sums = [shape(t) for t in tokens], checksums(tokens)
    result = []
    for i, token in enumerate(tokens):
        digits = sum("0" <= c <= "9" for c in token)
        near = [shapes[i + d] if 0 <= i + d < len(tokens) else "^$"[d > 0] for d in (-2, -1, 1, 2)]
        before = tokens[i - 1].lower()[:12] if i else ""
        names = [
            "bias",
            f"s={shapes[i]}",
            f"n={digits}",
            f"a={any(c.isalpha() for c in token)}{'@' in token}{'.' in token}{'-' in token}",
            f"f={token[:1] if not token[:1].isalnum() else 'w'}",
            f"p={before if before.isalpha() else '#'}",
            f"p1={near[1]}",
            f"n1={near[2]}",
            f"p1s={near[1]}|{shapes[i]}",
            f"sn1={shapes[i]}|{near[2]}",
            f"p2p1={near[0]}|{near[1]}",
            f"n1n2={near[2]}|{near[3]}",
            f"c={sums[i]}",
            f"cs={sums[i]}|{shapes[i]}",
            f"pc={sums[i - 1] if i else '^'}|{sums[i]}",
        ]
        result.append([zlib.crc32(n.encode()) & ((1 << FEATURE_BITS) - 1) for n in names])
    return result


# --- the field

def _may_follow() -> np.ndarray:
    """An inside label only continues its own kind; the extra row is the start."""
    allowed = np.ones((len(LABELS) + 1, len(LABELS)), dtype=bool)
    for j, label in enumerate(LABELS):
        if label.startswith("I-"):
            allowed[:, j] = False
            allowed[LABELS.index("B" + label[1:]), j] = allowed[j, j] = True
    return allowed


ALLOWED = _may_follow()


class Field:
    """Emission weights by feature and transition weights; forbidden transitions are far below all others."""

    def __init__(self, emission: np.ndarray | None = None, transition: np.ndarray | None = None):
        n = len(LABELS)
        self.emission = np.zeros((1 << FEATURE_BITS, n)) if emission is None else emission
        self.transition = np.zeros((n + 1, n)) if transition is None else transition

    def scores(self) -> np.ndarray:
        return np.where(ALLOWED, self.transition, -1e4)

    def batch(self, rows: Sequence[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Emissions (sequence, place, label), filled up with zeros, and the lengths."""
        lengths = np.array([len(r) for r in rows])
        emissions = np.zeros((len(rows), lengths.max(), len(LABELS)))
        for i, r in enumerate(rows):
            emissions[i, : len(r)] = self.emission[np.array(r)].sum(axis=1)
        return emissions, lengths

    def viterbi(self, rows: Sequence[list[list[int]]]) -> list[np.ndarray]:
        """The best labels of each sequence."""
        emissions, lengths = self.batch(rows)
        n, longest, _ = emissions.shape
        moves, best = self.scores(), None
        back = np.zeros((n, longest, len(LABELS)), dtype=np.int8)
        best = emissions[:, 0] + moves[-1]
        for t in range(1, longest):
            reach = best[:, :, None] + moves[None, :-1]
            back[:, t] = reach.argmax(axis=1)
            new = reach.max(axis=1) + emissions[:, t]
            best = np.where((t < lengths)[:, None], new, best)
        paths = np.zeros((n, longest), dtype=np.int64)
        at = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            inside = t < lengths
            paths[:, t] = np.where(inside, at, 0)
            at = np.where(inside & (t > 0), back[np.arange(n), t, at], at)
        return [path[:length] for path, length in zip(paths, lengths)]

    def gradient(self, rows: Sequence[list[list[int]]], gold: Sequence[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        """Negative log likelihood and its gradients, by the forward and backward sums of a batch."""
        emissions, lengths = self.batch(rows)
        n, longest, k = emissions.shape
        moves, allowed = self.scores(), ALLOWED
        forward = np.zeros((n, longest, k))
        forward[:, 0] = emissions[:, 0] + moves[-1]
        for t in range(1, longest):
            forward[:, t] = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves[None, :-1], axis=1) + emissions[:, t]
        backward = np.zeros((n, longest, k))
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(moves[None, :-1] + (emissions[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where((t + 1 < lengths)[:, None], step, 0.0)
        total = np.logaddexp.reduce(forward[np.arange(n), lengths - 1], axis=1)
        inside = np.arange(longest)[None] < lengths[:, None]
        expected = np.exp(forward + backward - total[:, None, None]) * inside[:, :, None]
        d_move = np.zeros_like(self.transition)
        d_move[-1] = expected[:, 0].sum(axis=0)
        for t in range(1, longest):
            pair = forward[:, t - 1, :, None] + moves[None, :-1] + (emissions[:, t] + backward[:, t])[:, None, :]
            d_move[:-1] += (np.exp(pair - total[:, None, None]) * inside[:, t, None, None]).sum(axis=0)
        loss = total.sum()
        for i, labels in enumerate(gold):
            expected[i, np.arange(len(labels)), labels] -= 1
            previous = np.concatenate([[k], labels[:-1]])
            np.add.at(d_move, (previous, labels), -1)
            loss -= emissions[i, np.arange(len(labels)), labels].sum() + moves[previous, labels].sum()
        d_emission = np.zeros_like(self.emission)
        for i, r in enumerate(rows):
            numbers = np.array(r)
            np.add.at(d_emission, numbers, np.broadcast_to(expected[i, : len(r), None], (*numbers.shape, k)))
        return loss, d_emission, np.where(allowed, d_move, 0)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, emission=self.emission, transition=self.transition)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Field:
        arrays = np.load(io.BytesIO(data))
        return Field(arrays["emission"], arrays["transition"])


def labels_of(sequence: Sequence_, spans: Sequence[Span]) -> np.ndarray:
    labels = np.zeros(len(sequence.tokens), dtype=np.int64)
    for start, end, kind in spans:
        inside = [i for i, (a, b) in enumerate(sequence.spans) if a < end and b > start]
        for n, i in enumerate(inside):
            labels[i] = LABELS.index(("I-" if n else "B-") + kind)
    return labels


def fit(labelled: Sequence[tuple[str, Sequence[Span]]], epochs: int = 30, batch: int = 64, rate: float = 0.3, penalty: float = 1e-3) -> Field:
    """A field from texts and their spans."""
    rows, gold = [], []
    for text, spans in labelled:
        for sequence in sequences(text):
            rows.append(features(sequence.tokens))
            gold.append(labels_of(sequence, spans))
    field, rng = Field(), np.random.default_rng(3)
    seen = [np.full_like(field.emission, 1e-6), np.full_like(field.transition, 1e-6)]
    for _ in range(epochs if rows else 0):
        order = rng.permutation(len(rows))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            _, *gradients = field.gradient([rows[i] for i in chosen], [gold[i] for i in chosen])
            for value, gradient, total in zip((field.emission, field.transition), gradients, seen):
                gradient = gradient / len(chosen) + penalty * value
                total += gradient * gradient
                value -= rate * gradient / np.sqrt(total)
    return field


# --- the default labelled table: rules that write examples

# Sentences with a place for the entity, per kind, and sentences with numbers that aren't personal.
FRAMES = {
    "email": ("write to {} today", "contact: {}", "mail an {} bitte", "courriel {} merci", "correo {} gracias", "{}"),
    "ip": ("from {} at noon", "host {} is down", "server {} antwortet", "adresse {} du serveur", "ip {}", "{}"),
    "card": ("card {} was charged", "pay with {} now", "Karte {} bezahlt", "carte {} valide", "tarjeta {} cargada", "{}"),
    "phone": ("call {} after six", "phone: {}", "tel {} bitte", "Telefon {} anrufen", "appelez le {} demain", "llame al {} hoy", "{}"),
}
OTHER = (
    "version {v} of the text", "in {y} and {y}", "license {v}, see page {n}", "token = \"{h}\" and", "password={h} then",
    "key {k} was set", "chapter {n} of {n}", "about {n} words in {n} lines", "price {n}.{n} euro", "order {l} shipped", "on {y}-{m}-{m} at {m}:{m}",
    "row {n} | {n} | {n} | {n}", "id {l} {l} {l}", "{n} {n} {n} {n} {n}", "BY-NC {v} and {v}", "isbn {l}", "no @ here {n}", "sum {l}.{n}", "@{w} said {n}", "{y}/{y} season",
)


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _word(rng: np.random.Generator) -> str:
    return "".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(3, 9)))


def _card_number(rng: np.random.Generator, n: int, right: bool = True) -> str:
    body = f"{rng.integers(3, 7)}" + _digits(rng, n - 2)
    return next(body + d for d in rng.permutation(list("0123456789")) if _luhn(body + d) == right)


def _written_card(number: str, pick: int) -> str:
    return " ./-"[pick].join(number[i : i + 4] for i in range(0, len(number), 4))


def _entity(kind: str, rng: np.random.Generator) -> str:
    pick = int(rng.integers(0, 6))
    if kind == "email":
        user = f"{_word(rng)}.{_digits(rng, 2)}"
        host = [f"{_word(rng)}.example.com", f"{_word(rng)}{_digits(rng, 1)}.example.com", f"{_word(rng)}-{_word(rng)}.org", f"{_word(rng)}.net"][int(rng.integers(0, 4))]
        return [f"{user}@{host}", f"{_word(rng)}@{host}", f"{_word(rng)}@{_word(rng)}.org", f"{_word(rng)} @ {host}", f"{user} @ {host}", f"{user}@{host}"][pick]
    if kind == "ip":
        parts = [str(x) for x in rng.integers(0, 256, 4)]
        six = ":".join(f"{x:x}" for x in rng.integers(4096, 65536, 8))
        return [".".join(parts), ".".join(parts), f"{'.'.join(parts)}:{rng.integers(80, 9999)}", six, " . ".join(parts), ".".join(parts)][pick]
    if kind == "card":
        number = _card_number(rng, 16)
        return [number, *(_written_card(number, i) for i in (0, 3, 1, 2)), _card_number(rng, 13)][pick]
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{_digits(rng, 2)} {a} {b}{c}", f"{a}.{b}.{c}", f"0{a} / {b}{c}"][pick]


def labelled_table(per_frame: int = 14, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Some 900 short texts with the spans of their personal data, made from the frames above.

    Numbers written like cards that fail Luhn stand in the card frames too, without a span, and two cards side by side have two.
    """
    rng, rows = np.random.default_rng(seed), []
    for kind, frames in FRAMES.items():
        for frame in frames:
            for _ in range(per_frame):
                left, right = frame.split("{}")
                left = f"{_word(rng)} {_word(rng)} {left}" if rng.random() < 0.5 else left
                right = f"{right} {_word(rng)}, {_word(rng)}" if rng.random() < 0.5 else right
                entity = _entity(kind, rng)
                rows.append((left + entity + right, [(len(left), len(left) + len(entity), kind)]))
                if kind == "card":
                    form = int(rng.integers(0, 4))
                    wrong = _card_number(rng, 16, False)
                    rows.append((left + (_written_card(wrong, form) if rng.random() < 0.7 else wrong) + right, []))
                    one, two = (_written_card(_card_number(rng, 16), form) for _ in range(2))
                    middle = len(left) + len(one)
                    rows.append((f"{left}{one} {two}{right}", [(len(left), middle, kind), (middle + 1, middle + 1 + len(two), kind)]))
    for frame in OTHER:
        for _ in range(per_frame):
            text = frame
            while "{" in text:
                at = text.index("{")
                value = {
                    "v": f"{rng.integers(1, 9)}.{rng.integers(0, 9)}",
                    "y": str(rng.integers(1900, 2030)),
                    "n": _digits(rng, int(rng.integers(1, 5))),
                    "m": _digits(rng, 2),
                    "l": _digits(rng, int(rng.integers(5, 12))),
                    "h": "".join(rng.choice(list("0123456789abcdef"), int(rng.integers(16, 41)))),
                    "k": "AKIA" + "".join(rng.choice(list("ABCDEFGHKLMN23456789"), 16)),
                    "w": _word(rng),
                }[text[at + 1]]
                text = text[:at] + value + text[at + 3 :]
            rows.append((f"{_word(rng)} {text} {_word(rng)}", []))
    return rows


# --- the operator

def added_spans(texts: Sequence[str], base: Sequence[Sequence[Span]], field: Field, cells: int = 200_000) -> list[list[Span]]:
    """The spans that the field adds to each text."""
    work = [(i, s) for i, text in enumerate(texts) for s in sequences(text)]
    work.sort(key=lambda w: len(w[1].tokens))
    added: list[list[Span]] = [[] for _ in texts]
    low = 0
    while low < len(work):
        high = low + 1
        while high < len(work) and (high - low + 1) * len(work[high][1].tokens) <= cells:
            high += 1
        paths = field.viterbi([features(s.tokens) for _, s in work[low:high]])
        for (i, sequence), path in zip(work[low:high], paths):
            for a, b, kind in _label_runs(path):
                start, end = sequence.spans[a][0], sequence.spans[b - 1][1]
                inside = texts[i][start:end]
                digits = sum("0" <= c <= "9" for c in inside)
                fits = digits >= DIGITS_NEEDED[kind] and ("@" in inside) == (kind == "email")
                fits &= kind != "ip" or inside.count(".") >= 3 or inside.count(":") >= 3
                fits &= kind != "card" or (digits <= 19 and _luhn(_NOT_DIGIT.sub("", inside)))
                if fits and not any(x < end and y > start for x, y, _ in base[i]):
                    added[i].append((start, end, kind))
        low = high
    return added


def _label_runs(path: np.ndarray) -> Iterator[tuple[int, int, str]]:
    i = 0
    while i < len(path):
        label = LABELS[path[i]]
        j = i + 1
        if label != "O":
            while j < len(path) and LABELS[path[j]] == "I" + label[1:]:
                j += 1
            yield i, j, label[2:]
        i = j


def _may_hold(texts: pa.Array) -> np.ndarray:
    """Texts with a digit or an at sign; the others have no spans."""
    data, offsets = raw_bytes(texts)
    return sums_between(((data >= 0x30) & (data <= 0x39)) | (data == 0x40), offsets) > 0


def find_spans(texts: pa.Array, field: Field) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and all spans of each text."""
    base: list[list[Span]] = [[] for _ in range(len(texts))]
    every: list[list[Span]] = [[] for _ in range(len(texts))]
    some = np.flatnonzero(_may_hold(texts)).tolist()
    held = texts.take(pa.array(some, pa.int64())).to_pylist()
    own = [base_spans(t) for t in held]
    for i, spans, more in zip(some, own, added_spans(held, own, field)):
        base[i], every[i] = spans, in_order([*spans, *more])
    return base, every


def find_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """Per row: `doc_id`, the number of base spans of each kind, `base_sha256`, and all `spans` as `kind:start:end` in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(field.to_bytes())  # some 600 KB, whatever the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field.from_bytes(shared.value)
        for batch in batches:
            for piece in pieces(batch):
                base, every = find_spans(piece.column(1), model)
                counts = [pa.array([sum(s[2] == k for s in spans) for spans in base], pa.int64()) for k in KINDS]
                digests = pa.array([hashlib.sha256(written(spans).encode()).hexdigest() for spans in base], pa.string())
                names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *counts, digests, pa.array([written(s) for s in every], pa.string())], names=names
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
