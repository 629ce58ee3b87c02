"""Plain versions of the operators, and small tables with odd rows, to test against."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

#: Columns that are called like names used inside the operators.
CLASHING = ("key", "found", "start", "score", "row_", "code", "core", "seed", "vector", "ids", "kept")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in CLASHING],
])


def table(spark, rows: list[tuple]):
    """Documents from (doc_id, text) or (doc_id, text, lang), with clashing further columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1]),
             *["x"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(rng: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(seed: int = 3) -> list[tuple]:
    """Random texts that share passages, whole and edited copies, and odd rows."""
    rng = random.Random(seed)
    passage = words(rng, 90)
    base = [words(rng, rng.randrange(60, 300)) for _ in range(12)]
    rows: list[tuple] = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(12, 24):  # the passage, or a part of it, between own words
        a, b = sorted(rng.sample(range(len(passage)), 2)) if i % 2 else (0, len(passage))
        rows.append((i, " ".join(words(rng, 30) + passage[a:b] + words(rng, rng.randrange(40)))))
    for i in range(24, 34):  # near copies with a word replaced, a word left out or an own end
        copy = list(base[i % 4])
        copy[rng.randrange(len(copy))] = "new"
        if i % 3 == 0:
            del copy[rng.randrange(len(copy))]
        rows.append((i, " ".join(copy)))
    rows += [(34, rows[0][1]), (35, rows[0][1]), (36, rows[13][1])]
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, "short"), (44, "short"), (45, "Öl für Ärzte\n" * 60),
             (46, "ab " * 3000), (47, "a" * 5000), (48, " ".join(words(rng, 4000, 40))), (49, rows[48 - 34][1])]
    rows += [(None, rows[1][1]), (None, None), (3, rows[3][1]), (3, rows[3][1])]
    rng.shuffle(rows)
    return rows


WORD = re.compile("[^\x20\x09-\x0d]+")


def kept_words(rows: list[tuple], length: int) -> dict:
    """doc_id to its words and those removed, for rows with an id."""
    first: dict[tuple, int] = {}
    split = {(d, t): WORD.findall(t or "") for d, t, *_ in rows if d is not None}
    for (d, _), w in split.items():
        for i in range(len(w) - length + 1):
            window = tuple(w[i:i + length])
            first[window] = min(d, first.get(window, d))
    out = {}
    for (d, _), w in split.items():
        gone = {i + j for i in range(len(w) - length + 1) if first[tuple(w[i:i + length])] < d for j in range(length)}
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def kept_bytes(rows: list[tuple], length: int) -> dict:
    """doc_id to its bytes, the number removed, the runs and the rest, for rows with an id."""
    times: dict[bytes, int] = {}
    split = [(d, (t or "").encode()) for d, t, *_ in rows if d is not None]
    for _, b in split:
        for i in range(len(b) - length + 1):
            times[b[i:i + length]] = times.get(b[i:i + length], 0) + 1
    out = {}
    for d, b in split:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if times[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[d] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


def shingles(text: str | None, n: int) -> set:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def classes(rows: list[tuple], n: int, percent: int) -> dict:
    """doc_id to the size of its set and the smallest id reachable over links."""
    sets = {d: shingles(t, n) for d, t, *_ in rows if d is not None}
    found = {d: d for d in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(found[a], found[b])
            changed |= found[a] != low or found[b] != low
            found[a] = found[b] = low
    return {d: (len(s), found[d]) for d, s in sets.items()}


def distance(a: str, b: str, most: int) -> int:
    """The edit distance of two texts, or more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        if min(row) > most:
            return most + 1
    return row[-1]


def kept_lines(rows: list[tuple], least: int, edits: int = 1) -> dict:
    """doc_id to its line count, the removed lines' numbers and the rest, for rows with an id."""
    texts = dict(sorted((d, t) for d, t, *_ in rows if d is not None and t is not None))
    seen: list[str] = []
    out = {d: (0, [], "") for d, t, *_ in rows if d is not None and t is None}
    for d, t in texts.items():
        gone = []
        lines = t.split("\n")
        for i, line in enumerate(lines):
            if line.strip(" \t\n\v\f\r"):
                if line in seen or len(line) >= least and any(len(o) >= least and distance(line, o, edits) <= edits for o in set(seen)):
                    gone.append(i)
                seen.append(line)
        out[d] = (len(lines), gone, "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


_UNSPACED = "\u0e00-\u0eff\u1000-\u10bf\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff"
TOKEN = re.compile(f"[{_UNSPACED}]|(?:(?![{_UNSPACED}])[a-z0-9\x80-\U0010ffff])+")


def passages(rows: list[tuple], items: list[tuple], span: int, substitutions: int, least: int) -> dict:
    """(doc_id, item, offset) to the document's places that are shared."""
    out: dict[tuple, set] = {}
    for d, t, *_ in rows:
        a = TOKEN.findall((t or "").lower())
        for item, text in items:
            b = TOKEN.findall((text or "").lower())
            n, allowed = (span, substitutions) if len(b) >= span else (len(b), int(len(b) >= 8))
            if d is None or item is None or n < least:
                continue
            for i in range(len(a) - n + 1):
                for j in range(len(b) - n + 1):
                    if sum(x != y for x, y in zip(a[i:i + n], b[j:j + n], strict=True)) <= allowed:
                        out.setdefault((d, item, i - j), set()).update(range(i, i + n))
    return out
