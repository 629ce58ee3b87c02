"""Personal data in texts: fixed patterns, and a conditional random field that finds more.

*Patterns* find e-mail addresses, IP addresses, card numbers and phone numbers, each kind
from the left and without overlaps; matches that fail their test are dropped. They take time in
proportion to the text, whatever it holds.

*The model* is a linear-chain conditional random field over the words of a text. Its labels are
"outside" and, for each kind, "begins" and "goes on". A word's features are its shape (runs
of digits, capitals and small letters as one sign each, other signs as they are), the number of its
digits, its first and last sign, some words that stand for signs in addresses, whether its digits
pass the card test, and the shapes and numbers of digits of both neighbours. It is trained by
gradient on a small labelled table: the lines below, which hold what the patterns miss (numbers
broken over lines, without a country's prefix, spelled-out addresses) and what is no personal data, and
passages of a bounded sample of texts, labelled by the patterns. Training runs on the driver.

*Decoding* is Viterbi's algorithm in numpy, for all texts of a batch at once. A word whose scores
favour "outside" by more than any two transitions could make up for is outside on
every best path; so the chain falls apart there, and only the stretches between go through
the algorithm. That is exact. Spans of the model are added if they pass a test of their kind and
overlap no span of the patterns; those of the patterns always stay.

Places are counted in code points, the end exclusive. Defined cases: a null or empty text has
no spans; rows without id, repeated rows and equal texts are rows of their own; an empty table
gives an empty one, and the model then learns from its lines only; further columns are dropped
unless named in ``keep``. Texts of any length are taken whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text_arrays import SpanHash, lower_ascii, mix, slices, utf8_buffers, word_spans

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)
#: Texts of the sample, and the most characters that one of them has.
SAMPLE, SAMPLE_CHARS = 300, 20_000
#: Words to both sides of a span in a passage to learn from.
AROUND = 8
#: Words of a passage at most; longer ones are not learned from.
LONGEST = 60

# The patterns of the four kinds.
_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int, int]  # kind, start, end

# Labelled lines; a span stands in double brackets, its kind before a bar.
LABELLED = """
please call [[phone|(743) 555-3824]] after six
you can ring [[phone|743-555-3824]] or come by
tel. [[phone|+1
(826) 555-4081]] any day
dial [[phone|+49
30 901820]] for help
the office at [[phone|+44 20
7946 0958]] is open
phone: [[phone|030 90182010]] in the morning
call me under [[phone|(826) 555-4081]].
my number is [[phone|826.555.4081]], call me
fax [[phone|+33 1 44
55 66 77]] please
reach us on [[phone|(555) 867-5309]] today
number [[phone|415-555-2671]] is new
write to [[email|anna.berg (at) mail.example.com]] soon
mail [[email|anna [at] example [dot] org]] for details
send it to [[email|j.smith at mail dot example dot com]] please
ask [[email|info(at)example.net]] about it
contact [[email|team[at]example[dot]com]] now
write to [[email|max@
mail.example.com]] about it
paid with [[card|4111 1111
1111 1111]] last week
card [[card|5500 0000
0000 0004]] was used
charge [[card|4111.1111.1111.1111]] again
visa [[card|4012/8888/8888/1881]] on file
number [[card|3782.822463.10005]] expired
mobile [[phone|+1 (826) 555-4081]] [[ip|190.137.223.204]] of the host
de [[phone|+1 (843) 555-7672]] [[ip|170.106.47.218]] et
on [[phone|+1 (326) 555-1781]] [[card|4012888888881881]] and
write [[card|4111111111111111]] 3 times
the [[card|5500000000000004]] 12 of it
server [[ip|192[.]168[.]10[.]24]] went down
block [[ip|10[.]0[.]12[.]7]] at once
node [[ip|10[.]21[.]33[.]44]] is slow
gateway [[ip|172[.]31[.]5[.]9]] and more
from [[ip|172.16[.]254.1]] came a request
host [[ip|2001:0db8:85a3:0000:0000:8a2e:0370:7334]] replied
born on 12.03.1987 in a small town
the meeting on 2021-11-30 was moved to 2021-12-05
version 3.11.4 follows version 3.10
it costs 1,299.00 or 1.299,00 in all
pages 112-118 and 203-209 of volume 14
at 10:30 or 14:45 in room 204
order 20211130-0042 has 3 items
isbn 978-3-16-148410-0 is out of print
chapter 4.2.1.3 deals with it
section 10.2.1.4. of the manual
invoice 9807915762804490 was paid
number 4381893557741608 is not one
reference 1234 5678 9012 3456 of the case
in 1999 2000 2001 2002 and 2003 it grew
sizes 12 14 16 18 20 22 and 24
the 1 2 3 4 5 6 7 8 9 10 of it
5 000 000 people in 40 000 places
meet at noon at the mill by the river at last
he looked at her and she dot by dot at him
look at it (at least once) and leave
@home and @work are words
ratio 3:2 and 16:9 on the screen
12:30:45 and 08:15:00 on the clock
temperatures of -12 to +25 degrees
plus +5 points and +12 more
room 12-340 on floor 3
(2019) and (2020) were good
§ 823 and article 5.1 of the law
licensed under version 2.0. of 2004
token = "44d2b1c09fd311c3cf3163b66d5a9875b883d8ce" here
"""


# --- patterns ------------------------------------------------------------------

def passes_luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_octet(digits: str) -> bool:
    bare = digits.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        after = _AFTER_AT.match(text, at) if start < at else None
        if after:
            yield start, after.end()
            done = after.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start, then kind."""
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(_is_octet(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and 14 <= len(digits := _digits(m[0])) <= 19 and passes_luhn(digits):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], s[0]))


# --- features ------------------------------------------------------------------

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = ord("0"), ord("A"), ord("a"), ord("a")
_MERGED = np.zeros(256, bool)
_MERGED[[ord("0"), ord("A"), ord("a")]] = True

#: Words that stand for signs in spelled-out addresses.
SPELLED = frozenset({"at", "dot", "(at)", "[at]", "[dot]", "(dot)"})


def shape(word: str) -> str:
    """Runs of digits as 0, of capitals as A, of small and other letters as a; other signs as they are."""
    sizes: list[int] = []
    for c in _CLASS[np.frombuffer(word.encode(), np.uint8)].tolist():
        if not (sizes and sizes[-1] == c and _MERGED[c]):
            sizes.append(c)
    return bytes(sizes).decode()


def _digit_class(n: int) -> int:
    return n if n < 5 else 5 + sum(n >= limit for limit in (7, 9, 12, 14, 20))


def _marks(word: str) -> str:
    """What the shape does not say: spelled-out signs, and digits that pass the card test."""
    if word.lower() in SPELLED:
        return word.lower()
    digits = _digits(word) if len(word) < 40 else ""
    return "card" if 14 <= len(digits) <= 19 and passes_luhn(digits) else ""


def own_features(word: str) -> list[str]:
    form, digits = shape(word), _digit_class(len(_digits(word)))
    return ["bias", f"shape {form[:30]}", f"digits {digits}", f"first {form[0]}", f"last {form[-1]}",
            f"mark {_marks(word)}", f"both {digits} {form[:30]}"]


def neighbour_features(word: str | None) -> list[str]:
    """What a word says about the one beside it; none is at a text's end."""
    if word is None:
        return ["end"]
    return [f"shape {shape(word)[:12]}", f"digits {_digit_class(len(_digits(word)))}", f"mark {_marks(word)}"]


# --- model ---------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """Weights: a row of scores for every feature of a word, of the word before and of the one after; and transitions."""
    own: dict[str, np.ndarray]
    before: dict[str, np.ndarray]
    after: dict[str, np.ndarray]
    moves: np.ndarray

    def _sum(self, table: dict[str, np.ndarray], names: list[str]) -> np.ndarray:
        return sum((table[n] for n in names if n in table), np.zeros(LABELS))

    def tables(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of the given words, for themselves, for the next word, and for the one before; last, a text's end."""
        return (np.array([*[self._sum(self.own, own_features(w)) for w in words], np.zeros(LABELS)]),
                np.array([self._sum(self.before, neighbour_features(w)) for w in [*words, None]]),
                np.array([self._sum(self.after, neighbour_features(w)) for w in [*words, None]]))


def _steps(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Each step and how many of the sequences, longest first, still go on."""
    for step in range(int(lengths[0]) if len(lengths) else 0):
        yield step, int(np.searchsorted(-lengths, -step, side="left"))


def log_likelihood(scores: np.ndarray, moves: np.ndarray, first: np.ndarray, lengths: np.ndarray,
                   labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-probability of the labels of all sequences, with its gradients by scores and by moves.

    Sequences begin at ``first`` in ``scores``, longest first, and stand between two words outside.
    """
    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    steps = list(_steps(lengths))
    for step, n in steps:
        at = first[:n] + step
        ahead[at] = scores[at] + (moves[0] if step == 0 else lse(ahead[at - 1][:, :, None] + moves[None], 1))
    behind[first + lengths - 1] = moves[:, 0]
    for step, n in reversed(steps[1:]):
        at = first[:n] + step
        behind[at - 1] = lse(moves[None] + (scores[at] + behind[at])[:, None, :], 2)
    total = lse(ahead[first + lengths - 1] + moves[:, 0], 1)
    owner = np.empty(len(scores), np.int64)
    by_score, by_move = np.zeros_like(scores), np.zeros_like(moves)
    value = -float(total.sum())
    for step, n in steps:
        at = first[:n] + step
        owner[at] = np.arange(n)
        now = labels[at]
        last = labels[at - 1] if step else np.zeros(n, np.int64)
        value += float(scores[at, now].sum() + moves[last, now].sum())
        np.add.at(by_move, (last, now), 1)
        if step:
            joint = ahead[at - 1][:, :, None] + moves[None] + (scores[at] + behind[at])[:, None, :] - total[:n, None, None]
            by_move -= np.exp(joint).sum(axis=0)
    chance = np.exp(ahead + behind - total[owner][:, None])
    by_score[np.arange(len(scores)), labels] = 1
    by_score -= chance
    ends = first + lengths - 1
    value += float(moves[labels[ends], 0].sum())
    np.add.at(by_move, (labels[ends], 0), 1)
    by_move[:, 0] -= chance[ends].sum(axis=0)
    by_move[0] -= chance[first].sum(axis=0)
    return value, by_score, by_move


def viterbi(scores: np.ndarray, moves: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best labels of sequences that begin at ``first``, longest first, each between two words outside."""
    best, back = np.empty_like(scores), np.zeros(scores.shape, np.int8)
    steps = list(_steps(lengths))
    for step, n in steps:
        at = first[:n] + step
        if step:
            options = best[at - 1][:, :, None] + moves[None]
            back[at] = options.argmax(axis=1)
            best[at] = scores[at] + options.max(axis=1)
        else:
            best[at] = scores[at] + moves[0]
    labels = np.zeros(len(scores), np.int64)
    ends = first + lengths - 1
    labels[ends] = (best[ends] + moves[:, 0]).argmax(axis=1)
    for step, n in reversed(steps[1:]):
        at = first[:n] + step
        labels[at - 1] = back[at, labels[at]]
    return labels


def decode(scores: np.ndarray, moves: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The best labels of all texts' words, which lie between ``offsets``.

    Words certainly outside divide a text. To label a word so, and not k, loses at most what the
    moves to and from k can be better than those to and from outside.
    """
    loss = (moves - moves[:, :1]).max(axis=0) + (moves - moves[:1]).max(axis=1)
    open_ = (scores[:, :1] - scores <= loss)[:, 1:].any(axis=1)
    labels = np.zeros(len(scores), np.int64)
    places = np.flatnonzero(open_)
    if not len(places):
        return labels
    new = np.ones(len(places), bool)
    new[1:] = places[1:] != places[:-1] + 1
    new[np.searchsorted(places, offsets[(offsets > places[0]) & (offsets <= places[-1])])] = True
    begin = np.flatnonzero(new)
    lengths = np.diff(np.append(begin, len(places)))
    order = np.argsort(-lengths, kind="stable")
    labels[places] = viterbi(scores[places], moves, begin[order], lengths[order])
    return labels


# --- training ------------------------------------------------------------------

Example = tuple[list[str], list[int]]


def _labels(text: str, spans: list[Span]) -> Example:
    """Words of a text and their labels: a word belongs to the span that it overlaps."""
    words, labels, last = [], [], None
    for m in _WORD.finditer(text):
        span = next((s for s in spans if s[1] < m.end() and m.start() < s[2]), None)
        words.append(m[0])
        labels.append(0 if span is None else 1 + 2 * span[0] + (span is last))
        last = span
    return words, labels


def labelled_lines() -> list[Example]:
    """The lines above as examples."""
    found = []
    for line in re.split(r"\n(?!(?:[^\[]|\[(?!\[))*\]\])", LABELLED.strip("\n")):
        text, spans = "", []
        for part in re.split(r"(\[\[.*?\|.*?\]\](?!\]))", line, flags=re.S):
            if m := re.fullmatch(r"\[\[(\w+)\|(.*)\]\]", part, re.S):
                spans.append((KINDS.index(m[1]), len(text), len(text) + len(m[2])))
                part = m[2]
            text += part
        found.append(_labels(text, spans))
    return found


def passages(text: str, around: int = AROUND, most: int = 4) -> list[Example]:
    """Some passages of a text, labelled by the patterns: around spans and other words with digits, and its beginning."""
    words, labels = _labels(text, [s for s in base_spans(text)])
    marked = [i for i, w in enumerate(words) if labels[i] or any(c in "0123456789@+" for c in w)]
    found, done = [], -1
    for i in marked:
        if i >= done and len(found) < most:
            a, b = max(0, i - around), min(len(words), i + around)
            while a > 0 and labels[a]:
                a -= 1
            while b < len(words) and labels[b]:
                b += 1
            done = b
            if b - a <= LONGEST:
                found.append((words[a:b], labels[a:b]))
    if not found and words:
        found.append((words[:2 * around], labels[:2 * around]))
    return found


def fit(examples: list[Example], rounds: int = 120, rate: float = 0.2, decay: float = 1e-4) -> Field:
    """The field that gives the examples' labels the greatest probability, by gradient (Adam)."""
    examples = sorted([e for e in examples if e[0]], key=lambda e: -len(e[0]))
    lengths = np.array([len(w) for w, _ in examples])
    first = np.cumsum(lengths) - lengths
    labels = np.array([x for _, row in examples for x in row])
    names: dict[tuple[str, str], int] = {}
    rows: list[list[int]] = []
    for words, _ in examples:
        for i, word in enumerate(words):
            parts = [("own", n) for n in own_features(word)]
            parts += [("before", n) for n in neighbour_features(words[i - 1] if i else None)]
            parts += [("after", n) for n in neighbour_features(words[i + 1] if i + 1 < len(words) else None)]
            rows.append([names.setdefault(p, len(names)) for p in parts])
    held = np.zeros((len(rows), len(names)))
    for i, row in enumerate(rows):
        held[i, row] = 1
    weights = [np.zeros((len(names), LABELS)), np.zeros((LABELS, LABELS))]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        _, by_score, by_move = log_likelihood(held @ weights[0], weights[1], first, lengths, labels)
        for i, up in enumerate((held.T @ by_score, by_move)):
            up = up - decay * len(examples) * weights[i]
            mean[i] = 0.9 * mean[i] + 0.1 * up
            square[i] = 0.99 * square[i] + 0.01 * up * up
            weights[i] = weights[i] + rate * (mean[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.99 ** step)) + 1e-8)
    tables: dict[str, dict[str, np.ndarray]] = {"own": {}, "before": {}, "after": {}}
    for (table, name), i in names.items():
        tables[table][name] = weights[0][i]
    return Field(tables["own"], tables["before"], tables["after"], weights[1])


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, lines: Sequence[Example] | None = None) -> Field:
    """A field learned from the labelled lines and from passages of at most ``sample`` texts.

    The texts are the different ones of the smallest hashes among those of at most ``SAMPLE_CHARS`` characters.
    """
    texts = docs.select(F.col(text).cast("string").alias("text")).filter(F.length("text").between(1, SAMPLE_CHARS))
    hashed = texts.select("text", F.xxhash64("text").alias("hash"))
    # tasks send hashes to the driver first, then only the texts chosen
    last = hashed.select("hash").distinct().orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
    chosen = hashed.filter(F.col("hash") <= F.lit(last)).dropDuplicates(["hash"]).orderBy("hash").limit(sample).collect()
    examples = list(labelled_lines() if lines is None else lines)
    return fit(examples + [e for r in chosen for e in passages(r["text"])])


# --- spans ---------------------------------------------------------------------

# Signs that a span of each kind may begin and end with.
_EDGES = (r"[A-Za-z0-9]", r"[0-9a-fA-F:]", r"[0-9]", r"[0-9]")
_FRONT = (r"[A-Za-z0-9_%+]", r"[0-9a-fA-F:]", r"[0-9]", r"[+(0-9]")


def _tested(kind: int, text: str, start: int, end: int) -> Span | None:
    """The span without signs around it, if it passes the test of its kind."""
    part = text[start:end]
    front, behind = re.search(_FRONT[kind], part), re.search(_EDGES[kind] + r"(?!.*" + _EDGES[kind] + ")", part, re.S)
    if not front or not behind or behind.end() <= front.start():
        return None
    start, end = start + front.start(), start + behind.end()
    part = text[start:end]
    digits = _digits(part)
    if kind == 0:
        ok = re.search(r"[A-Za-z0-9_%+-]\s*(@|[(\[]at[)\]]|\sat\s)\s*[A-Za-z0-9]", part, re.I) and re.search(r"\.|dot", part, re.I)
    elif kind == 1:
        numbers = re.findall(r"[0-9]+", part)
        ok = (":" in part and len(part.split(":")) == 8) or (len(numbers) == 4 and all(_is_octet(x) for x in numbers))
    elif kind == 2:
        ok = 14 <= len(digits) <= 19 and passes_luhn(digits)
    else:
        ok = 8 <= len(digits) <= 15
    return (kind, start, end) if ok and end - start <= 200 else None


def _model_spans(text: str, labels: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[Span]:
    """Spans of the labels of a text's words, as far as they pass their test."""
    found: list[list[int]] = []
    last = -1
    for i in np.flatnonzero(labels).tolist():
        kind, goes_on = divmod(int(labels[i]) - 1, 2)
        if goes_on and last == i - 1 and found[-1][0] == kind:
            found[-1][2] = int(ends[i])
        else:
            found.append([kind, int(begins[i]), int(ends[i])])
        last = i
    return [s for kind, a, b in found if (s := _tested(kind, text, a, b))]


def _signatures(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """A number for every word by its features, and a word for each number."""
    classes = _CLASS[data]
    new = np.ones(len(data), bool)
    new[1:] = (classes[1:] != classes[:-1]) | ~_MERGED[classes[1:]]
    new[starts] = True
    place = np.append(0, np.cumsum(new))
    hashes = SpanHash.of_bytes(classes[new])(place[starts], place[stops])
    digits = np.append(0, np.cumsum(classes == ord("0")))
    n_digits = digits[stops] - digits[starts]
    limits = np.array([1, 2, 3, 4, 5, 7, 9, 12, 14, 20])
    hashes = hashes + mix(np.searchsorted(limits, n_digits, side="right").astype(np.uint64) + np.uint64(1))
    raw = data.tobytes()
    size = stops - starts
    # only these words may have marks: digits enough for a card, or the first two signs of a spelled-out one
    small = lower_ascii(data)
    two = small[starts].astype(np.int32) * 256 + small[np.minimum(starts + 1, len(data) - 1)]
    spelled = (size <= 5) & (size > 1) & np.isin(two, sorted({ord(w[0]) * 256 + ord(w[1]) for w in SPELLED}))
    for i in np.flatnonzero(((size < 40) & (n_digits >= 14)) | spelled).tolist():
        if mark := _marks(raw[starts[i]:stops[i]].decode()):
            hashes[i] ^= np.uint64(1 + sum(mark.encode()))
    _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    return which, [raw[starts[i]:stops[i]].decode() for i in at.tolist()]


def all_spans(column: pa.Array, field: Field) -> list[list[tuple[int, int, int, bool]]]:
    """For every text its spans by start, then kind, with whether the patterns found them."""
    data, offsets = utf8_buffers(column)
    starts, stops, firsts = word_spans(data, offsets)
    texts = column.to_pylist()
    labels = np.zeros(len(starts), np.int64)
    if len(starts):
        which, words = _signatures(data, starts, stops)
        own, before, after = field.tables(words)
        none = len(words)
        last, following = np.append(none, which[:-1]), np.append(which[1:], none)
        filled = firsts[:-1] < firsts[1:]
        last[firsts[:-1][filled]] = none
        following[firsts[1:][filled] - 1] = none
        labels = decode(own[which] + before[last] + after[following], field.moves, firsts)
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    found = []
    for i, text in enumerate(texts):
        spans = base_spans(text or "")
        a, b = firsts[i], firsts[i + 1]
        added = []
        if labels[a:b].any():
            zero = points[offsets[i]]
            model = _model_spans(text, labels[a:b], points[starts[a:b]] - zero, points[stops[a:b]] - zero)
            added = [s for s in model if not any(s[1] < t[2] and t[1] < s[2] for t in spans)]
        both = [(*s, True) for s in spans] + [(*s, False) for s in added]
        found.append(sorted(both, key=lambda s: (s[1], s[0])))
    return found


# --- over tables ---------------------------------------------------------------

_SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find_personal_data(docs: DataFrame, field: Field, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """What to ``keep`` of every row and its ``spans`` by start, then kind, with whether the patterns found each."""
    held = [f"kept{i}" for i in range(len(keep))]  # numbered names can't clash
    rows = docs.select(*[F.col(c).alias(h) for h, c in zip(held, keep, strict=True)], F.col(text).cast("string").alias("text"))
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in row]
                         for row in all_spans(part.column("text"), field)]
                yield pa.RecordBatch.from_arrays([*[part.column(h) for h in held], pa.array(spans, span_type)], [*held, "spans"])

    kinds = [f"{h} {rows.schema[h].dataType.simpleString()}" for h in held]
    out = rows.mapInArrow(found, ", ".join([*kinds, f"spans {_SPANS}"]))
    return out.select(*[F.col(h).alias(c) for h, c in zip(held, keep, strict=True)], "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")
