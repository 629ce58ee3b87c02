"""Periodic runs, personal data and vector clusters against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
from ordervane.llm import periodic_runs, personal_data, queries, text_arrays, va_clusters
from ordervane.session import scratch_folder
from pyspark.sql import functions as F


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def thue_morse(n: int) -> list[int]:
    return [bin(i).count("1") % 2 for i in range(n)]


# --- 11 periodic runs ------------------------------------------------------------

def plain_runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """Start, end and smallest period of all runs, by trying every period at every place."""
    smallest: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                smallest.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b, q) for (a, b), q in smallest.items())


def _periodic_texts(rng: random.Random) -> list[list[int]]:
    texts = []
    for _ in range(rng.randrange(1, 5)):
        words: list[int] = []
        while len(words) < rng.randrange(90):
            part = rng.random()
            if part < 0.3:
                words += [rng.randrange(rng.choice([2, 4, 50])) for _ in range(rng.randrange(20))]
            elif part < 0.8:
                block = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 9))]
                words += (block * 20)[:rng.randrange(60)]
            elif words:
                a = rng.randrange(len(words))
                words += words[a:a + rng.randrange(40)]
        texts.append(words)
    return texts + texts[:1]


@pytest.mark.parametrize("seed", range(150))
def test_runs_equal_those_of_all_periods_tried(seed):
    rng = random.Random(seed)
    texts, least = _periodic_texts(rng), rng.choice([12, 12, 16])
    offsets = np.cumsum([0, *map(len, texts)])
    words = np.array(sum(texts, []), np.int64)
    got = sorted(zip(*[x.tolist() for x in periodic_runs.find_runs(words, offsets, least)], strict=True))
    assert got == sorted((a + o, b + o, q) for o, t in zip(offsets.tolist(), texts, strict=False) for a, b, q in plain_runs(t, least))


@pytest.mark.parametrize("seed", range(30))
def test_grammar_yields_the_texts_and_repeats_no_pair(seed):
    texts = _periodic_texts(random.Random(seed))
    offsets = np.cumsum([0, *map(len, texts)])
    words = np.array(sum(texts, []), np.int64)
    if not len(words):
        return
    grammar = periodic_runs.compress(words, offsets)
    assert len(grammar.symbol) == sum(max(0, len(t) - 1) for t in texts)  # every join leaves one symbol less
    content: dict[int, list[int]] = {}
    for s, a, m, b in zip(grammar.symbol.tolist(), grammar.start.tolist(), grammar.middle.tolist(), grammar.end.tolist(), strict=True):
        assert a < m < b and any(o <= a and b <= p for o, p in itertools.pairwise(offsets.tolist()))
        assert content.setdefault(s, words[a:b].tolist()) == words[a:b].tolist()


def test_runs_of_hard_sequences():
    one = np.zeros(5000, np.int64)
    assert [x.tolist() for x in periodic_runs.find_runs(one, np.array([0, 5000]))] == [[0], [5000], [1]]
    morse = thue_morse(2048)  # has squares, but hashes of its halves collide modulo powers of two
    got = periodic_runs.find_runs(np.array(morse), np.array([0, 2048]))
    assert sorted(zip(*[x.tolist() for x in got], strict=True)) == plain_runs(morse)


def _plain_row(doc_id, text):
    words = plain.WORD.findall(text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        a = (h // 10) % len(words)
        p = 1 + (len(words) - a) // (3 + (h // 10) % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
    runs = plain_runs(words)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    best = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
    figures = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (doc_id, len(runs), *figures, sha("".join(f"{a},{b - a},{q}\n" for a, b, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_of_odd_rows(spark, tmp_path):
    rows = [r for r in plain.documents() if len(r[1] or "") < 9000] + [(i, "la li lu " * 5 + f"x{i} " * (i % 20)) for i in range(100, 160)]
    plain.table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_repair_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(_plain_row(d, t)) for d, t, *_ in rows)


def test_runs_keep_what_is_asked_for(spark):
    docs = plain.table(spark, [(1, "a b " * 10 + "\xa0c"), (None, None)])
    got = periodic_runs.find_periodic_runs(docs, keep=["doc_id", "key", "kept"]).orderBy("n_words").collect()
    assert got[0].asDict() == {"doc_id": None, "key": "x", "kept": "x", "n_words": 0, "runs": [], "collapsed": ""}
    assert (got[1]["runs"], got[1]["collapsed"], got[1]["n_words"]) == ([(0, 20, 2)], "a b \xa0c", 21)
    assert periodic_runs.find_periodic_runs(docs.limit(0)).collect() == []


# --- 12 personal data --------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    def digits(part: str) -> list[int]:
        return [int(c) for c in part if c in "0123456789"]

    def luhn(found: list[int]) -> bool:
        return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(found))) % 10 == 0

    spans = [(0, *m.span()) for m in EMAIL.finditer(text)]
    spans += [(1, *m.span()) for m in IP.finditer(text) if max(map(int, m[0].split("."))) <= 255]
    spans += [(2, *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    spans += [(3, *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], s[0]))


@pytest.mark.parametrize("seed", range(40))
def test_patterns_find_what_the_plain_ones_find(seed):
    rng = random.Random(seed)
    parts = ["a.b@c.d", "@", "@@", "x@y", "é@b.cz", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "001.02.3.4", ".", "-", " ", "+", "٣",
             "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+12", "(", ")", "7", "12", "é", "\n", "w"]
    for _ in range(60):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(20)))
        assert personal_data.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 100_000, "+" * 200_000, "+1(" * 60_000, "@a" * 100_000, "1 " * 100_000])
def test_patterns_take_long_texts(text):
    personal_data.base_spans(text)


@pytest.fixture(scope="module")
def field():
    return personal_data.fit(personal_data.labelled_lines())


def _random_chain(seed: int):
    rng = np.random.default_rng(seed)
    lengths = np.array([4, 3, 3, 1])
    return rng.normal(size=(11, personal_data.LABELS)), rng.normal(size=(personal_data.LABELS,) * 2), np.cumsum(lengths) - lengths, lengths, rng


def _paths(scores, moves):
    for path in itertools.product(range(personal_data.LABELS), repeat=len(scores)):
        whole = [0, *path, 0]
        yield sum(scores[i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(whole)), path


def test_likelihood_and_best_path_equal_all_paths_tried():
    scores, moves, first, lengths, rng = _random_chain(1)
    labels = rng.integers(0, personal_data.LABELS, len(scores))
    value, by_score, by_move = personal_data.log_likelihood(scores, moves, first, lengths, labels)
    best = personal_data.viterbi(scores, moves, first, lengths)
    expected = 0.0
    for a, n in zip(first, lengths, strict=True):
        options = list(_paths(scores[a:a + n], moves))
        every = np.array([x for x, _ in options])
        own = next(x for x, path in options if path == tuple(labels[a:a + n]))
        expected += own - every.max() - np.log(np.exp(every - every.max()).sum())
        assert tuple(best[a:a + n]) == max(options)[1]
    assert value == pytest.approx(expected)
    for array, gradient in ((scores, by_score), (moves, by_move)):
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in array.shape)
            array[at] += 1e-5
            more = personal_data.log_likelihood(scores, moves, first, lengths, labels)[0]
            array[at] -= 2e-5
            less = personal_data.log_likelihood(scores, moves, first, lengths, labels)[0]
            array[at] += 1e-5
            assert (more - less) / 2e-5 == pytest.approx(gradient[at], abs=1e-4)


@pytest.mark.parametrize("seed", range(20))
def test_divided_chain_has_the_best_path_of_the_whole(seed):
    rng = np.random.default_rng(seed)
    offsets = np.array([0, 0, 40, 41, 41, 90])
    scores = rng.normal(size=(90, personal_data.LABELS))
    scores[:, 0] += rng.choice([0, 3, 6, 12], 90)
    moves = rng.normal(size=(personal_data.LABELS,) * 2)
    got = personal_data.decode(scores, moves, offsets)
    for a, b in itertools.pairwise(offsets):
        if a < b:
            assert got[a:b].tolist() == personal_data.viterbi(scores[a:b], moves, np.array([0]), np.array([b - a])).tolist()


def test_signatures_tell_words_of_different_features_apart():
    words = ["at", "AT", "on", "dot", "(at)", "a1", "b22", "b222", "4111111111111111", "4111111111111112", "Ab.", "A-b", "éa", "xyz", "@", "7" * 60]
    data, offsets = text_arrays.utf8_buffers(pa.array([" ".join(words)]))
    which, shown = personal_data._signatures(data, *text_arrays.word_spans(data, offsets)[:2])
    for i, j in itertools.combinations(range(len(words)), 2):
        same = (personal_data.own_features(words[i]), personal_data.neighbour_features(words[i])) == (
            personal_data.own_features(words[j]), personal_data.neighbour_features(words[j]))
        assert (which[i] == which[j]) == same
    assert all(personal_data.own_features(shown[k]) == personal_data.own_features(w) for k, w in zip(which, words, strict=True))


def test_model_finds_unseen_numbers_and_leaves_clean_text(field):
    def added(text):
        (spans,) = personal_data.all_spans(pa.array([text]), field)
        return [(personal_data.KINDS[k], text[a:b]) for k, a, b, base in spans if not base]

    assert added("bitte ruf +1\n(312) 555-9917 an, ja") == [("phone", "+1\n(312) 555-9917")]
    assert added("ask for her on (206) 555-7716 then") == [("phone", "(206) 555-7716")]
    assert added("mail karl [at] sample [dot] net for it") == [("email", "karl [at] sample [dot] net")]
    assert added("host 10[.]20[.]30[.]40 fell") == [("ip", "10[.]20[.]30[.]40")]
    for clean in ("born on 03.11.1975 here", "in 1988 1989 and 1990 it was so", "he looked at it", "page 17 of 203, 4.5 points", "", None):
        assert added(clean) == []


def test_model_agrees_with_patterns_on_held_out_texts(spark, field):
    """Words that the patterns mark in the sample table, found by a model that learned from other texts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text IS NOT NULL").orderBy("doc_id")
    texts = [r["text"] for r in docs.select("text").collect() if len(r["text"]) < 20_000]
    learned = personal_data.fit(personal_data.labelled_lines() + [e for t in texts[:250] for e in personal_data.passages(t)])
    hit = true = given = 0
    for words, labels in [e for t in texts[250:] for e in personal_data.passages(t)]:
        own, before, after = learned.tables(words)
        n, at = len(words), np.arange(len(words))
        got = personal_data.decode(own[at] + before[np.append(n, at[:-1])] + after[np.append(at[1:], n)], learned.moves, np.array([0, n]))
        hit += sum(a == b > 0 for a, b in zip(got, labels, strict=True))
        true += sum(x > 0 for x in labels)
        given += int((got > 0).sum())
    assert true > 30 and hit >= 0.9 * true and hit >= 0.9 * given


def test_personal_data_of_odd_rows(spark, tmp_path):
    rows = [*plain.documents(), (60, "é a.b@c.de, 1.2.3.4 4111 1111 1111 1111 +1 (743) 555-3824 x"), (61, "9" * 6000), (62, "+1\n(743) 555-3824")]
    plain.table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_personal_data(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    wanted = []
    for doc_id, text, *_ in rows:
        spans = plain_spans(text or "")
        wanted.append((doc_id, *[sum(s[0] == k for s in spans) for k in range(4)],
                       sha(",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in spans))))
    found = got.collect()
    assert sorted(repr(tuple(r)[:6]) for r in found) == sorted(map(repr, wanted))
    texts = dict((d, t or "") for d, t, *_ in rows)
    for r in found:
        base = [f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(texts[r["doc_id"]])] if r["doc_id"] is not None else []
        assert set(base) <= set(r["spans"].split(","))
    assert personal_data.find_personal_data(plain.table(spark, []), personal_data.train(plain.table(spark, []))).collect() == []


def test_personal_data_keeps_what_is_asked_for(spark, field):
    docs = plain.table(spark, [(1, "a b@c.de"), (1, None)])
    got = personal_data.find_personal_data(docs, field, keep=["doc_id", "key", "start"]).collect()
    assert sorted((r["doc_id"], r["key"], r["start"], [tuple(s) for s in r["spans"]]) for r in got) == [
        (1, "x", "x", []), (1, "x", "x", [("email", 2, 8, True)])]


# --- 13 clusters ---------------------------------------------------------------------

def plain_clusters(rows: list[tuple], clusters: int, rounds: int, scale: int, dimensions: int) -> list[tuple]:
    kept = [(i, [np.floor(0) if x == 0 else x for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, va_clusters.exact_numbers(np.array(v, float), scale), v) for i, v in kept]
    first = sorted((sha(f"1:{i}"), v, w) for i, w, v in whole if i is not None)[:clusters]
    centroids = [w for _, _, w in first]
    if not centroids:
        return []

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(w, c, strict=True)), k) for k, c in enumerate(centroids)) for _, w, _ in whole]

    for _ in range(rounds):
        near = assign()
        for k in range(len(centroids)):
            held = [w for (_, w, _), (_, at) in zip(whole, near, strict=True) if at == k]
            if held:
                centroids[k] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    return [(i, k, d if d < 2 ** 63 else None, [str(x) for x in centroids[k]]) for (i, _, _), (d, k) in zip(whole, assign(), strict=True)]


def _clustered(spark, rows, **options):
    table = spark.createDataFrame([(i, v, "x", 1, True) for i, v in rows], "vec_id bigint, embedding array<double>, id string, cluster int, fetch boolean")
    found = va_clusters.cluster_vectors(spark, table.repartition(3), scratch_folder(spark, "clusters"), **options)
    return sorted([(r["vec_id"], r["cluster"], r["distance"], r["centroid"]) for r in found.collect()], key=repr)


@pytest.mark.parametrize("bits", [2, 4, 8])
def test_clusters_equal_plain_ones(spark, bits):
    rng = np.random.default_rng(bits)
    rows = [(i, (rng.normal(size=5) + 3 * (i % 4)).tolist()) for i in range(150)]
    rows += [(200, rows[0][1]), (3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (201, None), (202, [1.0] * 4), (203, [float("nan")] * 5),
             (204, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (205, [None, 0.0, 0.0, 0.0, 0.0]), (206, []), (207, [0.0] * 5), (208, [-40.0, 60.0, 0.0, 0.0, 9.5])]
    rng.shuffle(rows)
    got = _clustered(spark, rows, dimensions=5, clusters=6, rounds=3, scale=64, bits=bits)
    assert got == sorted(plain_clusters(rows, 6, 3, 64, 5), key=repr)


def test_clusters_of_very_large_numbers_are_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=3) * 10.0 ** rng.integers(0, 12)).tolist()) for i in range(60)] + [(70, [3e38, -1e300, 2.5]), (71, [1e9, 1e9, 1e9 + 1])]
    assert _clustered(spark, rows, dimensions=3, clusters=8) == sorted(plain_clusters(rows, 8, 3, 64, 3), key=repr)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [4.0, 4.0])]
    assert _clustered(spark, rows, dimensions=2) == sorted(plain_clusters(rows, 16, 3, 64, 2), key=repr)
    assert _clustered(spark, [(None, [0.5, 1.0]), (2, None)], dimensions=2) == []
    assert _clustered(spark, [], dimensions=2) == []


@pytest.mark.parametrize("bits", [2, 3, 6])
def test_intervals_hold_the_distance(bits):
    rng = np.random.default_rng(bits)
    numbers = np.floor(rng.normal(size=(300, 8)) * 40)
    firsts = [va_clusters._edges(int(x.min()), *map(int, np.quantile(x, [0.01, 0.99])), int(x.max()), 1 << bits) for x in numbers.T]
    assert all(len(f) <= 1 << bits for f in firsts)
    cells = va_clusters.Cells(firsts, [int(x) for x in numbers.max(axis=0)], bits)
    codes = cells.of(numbers)
    assert (cells.unpack(cells.pack(codes)) == codes).all() and len(cells.pack(codes)[0]) == bits
    centroids = [[int(x) for x in row] for row in numbers[:5]]
    tables = cells.tables(centroids)
    sums = sum(tables[d, codes[:, d]] for d in range(8))
    exact = ((numbers[:, None, :] - np.array(centroids)[None]) ** 2).sum(axis=2)
    assert (sums[:, :5] <= exact).all() and (exact <= sums[:, 5:]).all()
    near = va_clusters.decided(codes, tables)
    assert ((near < 0) | (near == exact.argmin(axis=1))).all()


def test_clusters_equal_sql(spark):
    from __spark_entry__ import oracle_sql
    from compare import oracle_connection, spark_rows, sql_rows

    folder = "/root/testdata/sf0.001"
    got = spark_rows(queries.op13_va_clusters(spark, folder))
    assert got == sql_rows(oracle_connection(folder), oracle_sql()["op13_va_clusters"])


def test_inertia_beyond_a_long_is_null(spark):
    found = spark.createDataFrame([(1, 0, 2 ** 62, ["0"]), (2, 0, 2 ** 62, ["0"]), (3, 1, 5, ["1"])], "vec_id bigint, cluster int, distance bigint, centroid array<string>")
    got = va_clusters.with_inertia(spark, found, scratch_folder(spark, "inertia")).orderBy("vec_id").select("cluster_inertia", "inertia").collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), (5, None)]
    assert va_clusters.with_inertia(spark, found.filter(F.lit(False)), scratch_folder(spark, "inertia")).collect() == []
