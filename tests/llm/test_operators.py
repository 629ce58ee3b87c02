"""The operators against plain versions, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from ordervane.llm import (
    byte_bpe,
    decontaminate,
    hyperminhash,
    language_id,
    line_dedup,
    lm_score,
    neighbours,
    settings,
    substring_dedup,
    suffix_array,
    text_arrays,
    warc,
)
from ordervane.session import scratch_folder
from pyspark.sql import functions as F

LETTERS = {"en": "the and of with thing other ", "fr": "le été où déjà français ", "de": "über größe und nicht schön "}


def by_id(rows, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in rows if r["doc_id"] is not None}


# --- helpers -------------------------------------------------------------------

def test_words_and_span_hashes_of_odd_texts():
    texts = pa.array([None, "", " a\tb\x0bc ", "é a", "x", None])
    data, offsets = text_arrays.utf8_buffers(texts)
    starts, stops, firsts = text_arrays.word_spans(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, stops, strict=True)] == ["a", "b", "c", "é", "a", "x"]
    assert firsts.tolist() == [0, 0, 0, 3, 5, 6, 6]
    hashes = text_arrays.word_hashes(data, starts, stops)
    assert hashes[0] == hashes[4] and len(set(hashes.tolist())) == 5


def test_slices_of_an_array_read_their_own_texts():
    texts = pa.array(["aa", None, "b", "ccc"]).slice(1, 3)
    data, offsets = text_arrays.utf8_buffers(texts)
    assert bytes(data) == b"bccc" and offsets.tolist() == [0, 0, 1, 4]


def test_equal_windows_have_equal_anchor_offsets():
    rng = np.random.default_rng(1)
    codes = rng.integers(1, 5, 400).astype(np.uint64)
    spans = text_arrays.SpanHash(text_arrays.mix(codes))
    starts, anchors = text_arrays.anchor_of_windows(spans.windows(3), np.array([0, 150, 400]), 20, 3)
    assert starts.tolist() == [*range(131), *range(150, 381)]
    offsets = {}
    for s, a in zip(starts.tolist(), anchors.tolist(), strict=True):
        assert 0 <= a - s <= 17
        assert offsets.setdefault(tuple(codes[s:s + 20].tolist()), a - s) == a - s


def test_span_without_a_code_equals_the_shorter_span():
    codes = text_arrays.mix(np.array([5, 6, 7, 8, 5, 6, 8], np.uint64))
    spans = text_arrays.SpanHash(codes)
    at = np.array([0])
    assert spans.without(at, at + 2, at + 4) == spans(at + 4, at + 7)


@pytest.mark.parametrize("n", [1024, 4096])
def test_sequences_made_to_collide_have_different_hashes(n):
    word = np.array([bin(i).count("1") % 2 for i in range(n)], np.uint8)
    codes = np.concatenate([word, 1 - word])
    starts, stops = np.array([0, n]), np.array([n, 2 * n])
    as_bytes = text_arrays.word_hashes(codes + 97, starts, stops)
    as_words = text_arrays.SpanHash(text_arrays.mix(codes.astype(np.uint64) + np.uint64(7)))(starts, stops)
    assert as_bytes[0] != as_bytes[1] and as_words[0] != as_words[1]


def test_products_modulo_the_prime():
    rng, prime = random.Random(1), text_arrays.PRIME
    pairs = [(rng.randrange(prime), rng.randrange(prime)) for _ in range(20_000)] + [(prime - 1, prime - 1), (0, 5), (1, prime - 1)]
    got = text_arrays.times(*(np.array(x, np.uint64) for x in zip(*pairs, strict=True)))
    assert got.tolist() == [a * b % prime for a, b in pairs]
    codes = [rng.randrange(2**64) for _ in range(9000)]
    spans, total, sums = text_arrays.SpanHash(np.array(codes, np.uint64)), 0, [0]
    for i, c in enumerate(codes):
        total = (total + c * pow(text_arrays._POINT, i, prime)) % prime
        sums.append(total)
    assert spans._sums.tolist() == sums


def _hard_texts(n: int) -> list[tuple]:
    """Words, lines and runs of words that hashes modulo powers of two would take for equal."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    return [(1, one), (2, other), (3, " ".join(one)), (4, " ".join(other))]


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators_tell_texts_made_to_collide_apart(spark, n):
    rows = _hard_texts(n)
    docs = plain.table(spark, rows)
    items = spark.createDataFrame([(7, f"x y z {rows[0][1]} and more words that make it long enough for a seed of all of them")], "item_id long, text string")
    leaked = plain.table(spark, [(1, f"x y z {rows[1][1]} and some others, in a text that has nothing more of the item than that")])
    found = decontaminate.find_passages(spark, leaked, items, scratch_folder(spark, "t")).collect()
    assert found == []
    near = hyperminhash.near_duplicates(spark, plain.table(spark, rows[:2]), scratch_folder(spark, "t"), 4, 80).collect()
    assert by_id(near, "component_id") == {1: (1,), 2: (2,)}
    lines = line_dedup.remove_lines(spark, plain.table(spark, rows[:2]), scratch_folder(spark, "t")).collect()
    assert {r["doc_id"]: r["kept"] for r in lines} == dict(rows[:2])
    hashes, _ = lm_score.token_hashes(pa.array([rows[0][1], rows[1][1]]))
    assert len(set(hashes.tolist())) == 3
    cut = substring_dedup.remove_repeats(spark, docs, scratch_folder(spark, "t"), 50).collect()
    assert by_id(cut, "n_words", "n_removed", "kept") == plain.kept_words(rows, 50)


# --- 1 language ------------------------------------------------------------------

def _labelled(n: int) -> list[tuple]:
    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(LETTERS))
        rows.append((i, " ".join(rng.choices(LETTERS[lang].split(), k=rng.randrange(5, 40))), lang))
    return rows


def test_language_of_held_out_texts(spark):
    rows = [*_labelled(300), (900, None, "en"), (901, "", "de"), (902, "12 ?!", "en"), (903, "the and " * 4000, None),
            (None, "le été où", None), (904, "über größe", None), (904, "über größe", None)]
    docs = plain.table(spark, rows)
    learned = docs.filter(~language_id.held_out())
    net = language_id.train(learned, epochs=20)
    assert net.languages == ["de", "en", "fr"]
    # the label of what is judged must not matter
    got = language_id.label_languages(docs.withColumn("lang", F.lit("xx")), net, keep=["doc_id", "key"]).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "key", "lang_pred", "score"}
    found = by_id(got, "lang_pred", "score")
    wanted = {i: lang for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([found[i][0] == lang for i, lang in wanted.items()]) >= 0.95
    assert [found[i] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert found[903][0] == "en" and found[904][0] == "de" and 0 < found[904][1] <= 1
    assert [r["lang_pred"] for r in got if r["doc_id"] is None] == ["fr"]


def test_language_without_labels_is_unknown(spark):
    docs = plain.table(spark, [(1, "abc"), (2, None)])
    for part in (docs, docs.limit(0)):
        net = language_id.train(part)
        assert all(r["lang_pred"] == "und" for r in language_id.label_languages(part, net).collect())
    one = language_id.train(plain.table(spark, [(1, "abc", "en")]))
    assert language_id.label_languages(docs, one).filter("lang_pred = 'en'").count() == 1


def test_gradients_of_the_network_are_right():
    rng = np.random.default_rng(2)
    d = language_id._new_direction(rng, 3, 2)
    codes = rng.integers(97, 103, (5, 4)).astype(np.uint8)
    above = rng.standard_normal((5, 3, 4)).astype(np.float32)

    def loss() -> float:
        return float((language_id._forward(d, codes)[0] * above).sum(dtype=np.float64))

    grads = language_id._backward(d, codes, language_id._forward(d, codes)[1], above)
    for weights, grad in zip(d.arrays()[:3], grads, strict=True):
        for at in [tuple(rng.integers(0, s) for s in weights.shape) for _ in range(6)] + [(1, 99 % weights.shape[1])]:
            old = weights[at]
            weights[at] = old + 1e-2
            up = loss()
            weights[at] = old - 1e-2
            down = loss()
            weights[at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-2, abs=2e-2, rel=2e-2)


def test_labels_equal_a_plain_network_byte_by_byte():
    """All gates of both directions written out for one byte and one state at a time."""
    rng = np.random.default_rng(4)
    net = language_id.Network(["a", "b", "c"], language_id._new_direction(rng, 3, 3), language_id._new_direction(rng, 3, 3),
                              rng.standard_normal((3, 1)).astype(np.float32))
    net.ahead.bias[:] = rng.standard_normal((9, 1))
    texts = ["é" * 5, "", "x", "".join(chr(97 + i % 26) for i in range(600)), "Wörter und words"]
    data, offsets = text_arrays.utf8_buffers(pa.array(texts))

    def states(d, codes):
        h, out = np.zeros(3), []
        for code in codes:
            x = d.inputs[:, code].astype(float)
            u = [sum(d.states[i, j] * h[j] for j in range(3)) + d.bias[i, 0] for i in range(9)]
            soft = lambda v: v / (1 + abs(v))
            z, r = ([(soft(x[g * 3 + i] + u[g * 3 + i]) + 1) / 2 for i in range(3)] for g in (0, 1))
            new = [soft(x[6 + i] + r[i] * u[6 + i]) for i in range(3)]
            h = np.array([z[i] * h[i] + (1 - z[i]) * new[i] for i in range(3)])
            out.append(h)
        return out

    wanted: dict[int, list] = {}
    for t, text in enumerate(texts):
        raw = text.encode()
        for begin in range(0, len(raw), language_id.PIECE):
            piece = raw[begin:begin + language_id.PIECE]
            ahead, back = states(net.ahead, piece), states(net.back, piece[::-1])[::-1]
            rows = []
            for f, b in zip(ahead, back, strict=True):
                score = net.ahead.out @ f + net.back.out @ b + net.prior[:, 0]
                rows.append(np.exp(score - score.max()) / np.exp(score - score.max()).sum())
            wanted.setdefault(t, []).append(np.array(rows))
    chances, lengths, owner = language_id.label_bytes(net, data, offsets)
    for i, (n, t) in enumerate(zip(lengths, owner, strict=True)):
        at = next(k for k, w in enumerate(wanted[t]) if len(w) == n and np.allclose(chances[:n, :, i], w, atol=1e-4))
        wanted[t].pop(at)
    assert not any(wanted.values())


# --- 2 decontamination --------------------------------------------------------------

def test_masks_find_every_two_substitutions():
    for i in range(decontaminate.SPAN):
        for j in range(i, decontaminate.SPAN):
            assert any(i not in mask and j not in mask for mask in decontaminate.MASKS)
    for n in range(decontaminate.ONE_FROM, decontaminate.SPAN):
        own = [positions for length, positions, _ in decontaminate.PATTERNS if length == n]
        assert all(any(i not in positions for positions in own) for i in range(n))


def test_passages_equal_plain_comparison(spark):
    rng = random.Random(9)
    items = [(i, " ".join(plain.words(rng, n, 300))) for i, n in enumerate([13, 20, 35, 12, 5, 4, 8])]
    items += [(7, None), (8, ""), (None, items[1][1]), (1, items[1][1])]
    rows = plain.documents()[:30]
    for i in range(100, 130):
        item = items[i % 7][1].split()
        for _ in range(rng.randrange(4)):
            item[rng.randrange(len(item))] = "other"
        text = plain.words(rng, rng.randrange(20), 300) + item + plain.words(rng, rng.randrange(20), 300)
        rows.append((i, ", ".join(text).upper()))
    rows += [(131, None), (132, ""), (None, items[2][1]), (133, items[2][1] + " é " + items[2][1])]
    japanese = "吾輩は猫である。名前はまだ無い。"
    items += [(9, japanese), (10, "ใครขายไข่ไก่"), (11, "日本 is a country")]
    rows += [(134, f"Er sagt:{japanese.replace('猫', '犬')}so"), (135, "x ใครขายไข่ไก่ y"), (136, "日本 is a big country"), (137, "日本 IS A country")]
    tests = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, key string")
    found = decontaminate.find_passages(spark, plain.table(spark, rows), tests, scratch_folder(spark, "t")).collect()
    got: dict[tuple, set] = {}
    for r in found:
        got.setdefault((r["doc_id"], r["item_id"], r["begin"] - r["item_begin"]), set()).update(range(r["begin"], r["end"]))
    assert got == plain.passages(rows, items, 13, 2, 5) and got


def test_passages_of_empty_tables(spark):
    docs, items = plain.table(spark, [(1, "a b c")]), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_passages(spark, docs, items, scratch_folder(spark, "t")).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.find_passages(spark, docs.limit(0), some, scratch_folder(spark, "t")).count() == 0


# --- 3 language model --------------------------------------------------------------

def _scored(spark, docs):
    place = scratch_folder(spark, "lm")
    model = lm_score.train(spark, docs.filter(lm_score.trained_on()), f"{place}/counts")
    return model, lm_score.score(spark, docs, model, f"{place}/counts", f"{place}/texts").collect()


def test_scores_equal_a_plain_backoff_model(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the cat sat", "on the mat", "a Dog ran", "far away", f"w{i}"]) for _ in range(9)))
            for i in range(40)] + [(50, None), (51, ""), (52, "unseen words only"), (None, "the cat"), (3, "the cat sat")]
    model, got = _scored(spark, plain.table(spark, rows))
    assert len(got) == len(rows)
    end = ""

    def tokens(text):
        return [*(text or "").lower().split(), end]

    train = [tokens(t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    counts: dict[tuple, int] = {}
    for text in train:
        padded = [end, *text]
        for n in (2, 3):
            for i in range(len(padded) - n + 1):
                counts[tuple(padded[i:i + n])] = counts.get(tuple(padded[i:i + n]), 0) + 1
        for w in text:
            counts[(w,)] = counts.get((w,), 0) + 1
    total, types = sum(map(len, train)), sum(len(k) == 1 for k in counts)
    assert (model.tokens, model.types) == (total, types)
    vocabulary = [k[0] for k in counts if len(k) == 1] + ["unknown"]

    def chance(word: str, context: tuple) -> float:
        if not context:
            return (counts.get((word,), 0) + 0.5) / (total + 0.5 * (types + 1))
        stored = {k[-1]: c for k, c in counts.items() if k[:-1] == context and len(k) == len(context) + 1 and c >= 2}
        if len(context) == 2:  # a triple needs both its pairs
            stored = {w: c for w, c in stored.items() if counts.get((context[1], w), 0) >= 2}
        whole = counts.get(context, 0)
        if not stored or whole < 2:
            return chance(word, context[1:])
        if word in stored:
            return (stored[word] - 0.5) / whole
        rest = 1 - sum((c - 0.5) / whole for c in stored.values())
        return rest / (1 - sum(chance(w, context[1:]) for w in stored)) * chance(word, context[1:])

    assert sum(chance(w, ("the",)) for w in vocabulary) == pytest.approx(1)
    assert sum(chance(w, ("on", "the")) for w in vocabulary) == pytest.approx(1)
    texts = {(d, t) for d, t in rows}
    for d, t in texts:
        wanted, base = 0.0, 0.0
        context = [end, *tokens(t)]
        for i, w in enumerate(tokens(t)):
            wanted += np.log10(chance(w, tuple(context[max(0, i - 1):i + 1])))
            base += np.log10(chance(w, ()))
        known = sum((w,) in counts for w in tokens(t))
        assert any(r["doc_id"] == d and r["n_tokens"] == len(tokens(t)) and r["n_known"] == known
                   and r["score"] == pytest.approx(wanted) and r["base_score"] == pytest.approx(base) for r in got), (d, t)


def test_parts_do_not_decide_on_scores(spark, monkeypatch):
    docs = plain.table(spark, [r for r in plain.documents() if len(r[1] or "") < 3000])
    found = []
    for parts, least in ((1, 2), (4, 2), (1, 1), (2, 1)):
        monkeypatch.setattr(lm_score, "PARTS", parts)
        monkeypatch.setattr(lm_score, "LOOKUPS", 5 - parts)
        place = scratch_folder(spark, "lm")
        model = lm_score.train(spark, docs.filter(lm_score.trained_on()), f"{place}/counts", least_count=least)
        rows = lm_score.score(spark, docs, model, f"{place}/counts", f"{place}/texts").collect()
        found.append(sorted((r["doc_id"] or -1, r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows))
    assert found[0] == found[1] != found[2] == found[3]
    assert [spark.conf.get(name) for name in settings.SHUFFLES_DELETED] == ["false"]


def test_broadcast_size_does_not_decide_on_sequences(spark, monkeypatch):
    rng = random.Random(14)
    parts = ["the cat sat", "on the mat", "a dog ran", "far away", "so it is"] + [f"rare{i} pair{i} seen{i}" for i in range(20)]
    docs = plain.table(spark, [(i, " ".join(rng.choice(parts) for _ in range(9))) for i in range(60)])
    wanted = by_id(_scored(spark, docs)[1], "n_known", "base_score", "score")
    for arcs, weights in ((16, 1 << 21), (16, 64), (1, 1)):
        monkeypatch.setattr(lm_score, "MOST_ARCS", arcs)
        monkeypatch.setattr(lm_score, "MOST_WEIGHTS", weights)
        model, got = _scored(spark, docs)
        assert len(model.pairs) <= arcs and len(model.triples) <= arcs
        found = by_id(got, "n_known", "base_score", "score")
        assert found.keys() == wanted.keys() and all(found[d] == pytest.approx(wanted[d]) for d in wanted)


def test_scores_without_training_rows(spark):
    _, got = _scored(spark, plain.table(spark, [(None, "a b"), (None, None)]))
    assert {(r["n_tokens"], r["n_known"]) for r in got} == {(3, 0), (1, 0)}
    assert _scored(spark, plain.table(spark, [(1, "a")]).limit(0))[1] == []


def test_sequences_are_stored_by_bucket_and_lookups_read_tokens(spark):
    docs = plain.table(spark, [(i, " ".join(f"w{k} v{k}" for k in range(200))) for i in range(3)])
    stored = lm_score.count_sequences(docs, 2, buckets=4).collect()
    assert len(stored) == 8  # not a row for each of them
    assert {kind: sum(len(r["n"]) // 8 for r in stored if r["kind"] == kind) for kind in (0, 1)} == {0: 401, 1: 400}
    assert {n for r in stored for n in np.frombuffer(r["n"], np.int64).tolist()} == {3}
    place = scratch_folder(spark, "lm")
    model = lm_score.train(spark, docs, f"{place}/counts")
    lm_score.score(spark, docs, model, f"{place}/counts", f"{place}/texts").collect()
    texts = spark.read.parquet(f"{place}/texts/texts")
    assert "text" not in texts.columns and {len(r["tokens"]) for r in texts.collect()} == {8 * 401}


@pytest.mark.parametrize("least", [1, 2, 5, 1000])
def test_automaton_steps_as_a_walk_from_left_to_right(least):
    rng, random_ = np.random.default_rng(least), random.Random(least)
    texts = pa.array([" ".join(random_.choice("abcdefgh") for _ in range(random_.randrange(40))) for _ in range(30)] + [None])
    tokens, firsts = lm_score.token_hashes(texts)
    pairs, triples = lm_score._sequences(tokens, firsts)
    words, n = np.unique(tokens, return_counts=True)
    hot = words[(n >= 4 * least) | (words == lm_score.END)]
    kept = []
    for left, right, code, _ in (pairs, triples):
        codes, at, n = np.unique(code, return_index=True, return_counts=True)
        below = kept[0][0] if kept else hot
        ok = (n >= least) & np.isin(left[at], below) & np.isin(right[at], below)
        kept.append((codes[ok], left[at[ok]], right[at[ok]], rng.random(int(ok.sum()))))
    word_costs, pair_costs = (np.where(rng.random(k) < 0.5, -rng.random(k), 0.0) for k in (len(hot), len(kept[0][0])))
    none = np.zeros(0)
    model = lm_score.Automaton(len(tokens), len(words), 1, none, none, none, hot, word_costs, *kept[0], pair_costs, *kept[1])
    ids, root = lm_score._find(hot, tokens), -rng.random(len(tokens))
    got = model.traverse(ids, root, firsts, int(lm_score._find(hot, np.array([lm_score.END]))[0]))

    of_word = dict(zip(hot.tolist(), word_costs.tolist(), strict=True))
    of_pair = {(a, b): (np.log10(share), c) for _, a, b, share, c in zip(*(x.tolist() for x in (*kept[0], pair_costs)), strict=True)}
    names = {c: (a, b) for c, a, b in zip(*(x.tolist() for x in kept[0][:3]), strict=True)}
    of_triple = {(*names[a], names[b][1]): np.log10(share) for _, a, b, share in zip(*(x.tolist() for x in kept[1]), strict=True)}
    for i, (begin, end) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)):
        wanted, text = 0.0, [0, *tokens[begin:end].tolist()]
        for k in range(1, len(text)):
            if k > 1 and tuple(text[k - 2:k + 1]) in of_triple:
                wanted += of_triple[tuple(text[k - 2:k + 1])]
                continue
            wanted += of_pair.get(tuple(text[k - 2:k]), (0, 0))[1] if k > 1 else 0
            if (text[k - 1], text[k]) in of_pair:
                wanted += of_pair[text[k - 1], text[k]][0]
            else:
                wanted += of_word.get(text[k - 1], 0) + root[begin + k - 1]
        assert got[i] == pytest.approx(wanted)


def test_index_finds_what_there_is():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    codes[:50] = np.arange(50, dtype=np.uint64) << np.uint64(40)  # with one slot
    wanted = np.concatenate([codes[::3], codes[:50] + np.uint64(1 << 39), np.array([7], np.uint64)])
    places = {c: i for i, c in enumerate(codes.tolist())}
    assert lm_score._Index(codes).find(wanted).tolist() == [places.get(c, -1) for c in wanted.tolist()]
    assert lm_score._Index(codes[:0]).find(wanted[:2]).tolist() == [-1, -1]


def test_words_that_end_in_zeros_are_told_apart():
    words = [b"a" * n + b"\0" * zeros for n in range(1, 20) for zeros in range(6)]
    tokens, _ = lm_score.token_hashes(pa.array([b" ".join(words * 2).decode()]))
    assert len(set(tokens.tolist())) == len(words) + 1 and tokens[:len(words)].tolist() == tokens[len(words):-1].tolist()


# --- 4 neighbours ------------------------------------------------------------------

def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((700, 16)) * rng.uniform(0.5, 2, (700, 1))
    vectors[650:] = vectors[0]  # ties
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(1000, None, "x"), (1020, [0.0] * 16, "x"), (1040, [float("nan")] * 16, "x"), (1060, [None] + [1.0] * 15, "x"),
             (1080, [float("inf")] * 16, "x"), (1100, [1.0, 2.0], "x"), (1120, [], "x"), (None, vectors[3].tolist(), "x"),
             (20, vectors[20].tolist(), "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got: dict[int, list] = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0, most=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 700, 20))
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        assert all(s == pytest.approx(vectors[q] @ vectors[v], abs=1e-12) for _, v, s in found)
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len({v for _, v, _ in found} & set(np.lexsort((np.arange(700), -scores))[:20].tolist()))
    assert hits / (20 * len(got)) >= 0.9


def test_neighbours_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 4)))] + [(60 + i, [1.0] * 4) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, F.col("vec_id") == 60, most=20).orderBy("rank").collect()
    top = [r["vec_id"] for r in found if r["score"] == 4.0]
    assert top == list(range(61, 61 + len(top))) and len(found) == 20
    few = neighbours.nearest(table.filter("vec_id < 3"), F.col("vec_id") == 0, most=20)
    assert few.count() == 2
    assert neighbours.nearest(table.limit(0), F.col("vec_id") == 0).count() == 0


def test_neighbours_are_whole_whatever_the_norms(spark, monkeypatch):
    rng = np.random.default_rng(15)
    few = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate([np.array([1.0, 0, 0, 0]), np.array([-1.0, 0, 0, 0]),
                                                                       np.array([-1e-9, 1e-9, 0, 0])])], "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "HASHED_ROWS", 1)
    assert [r["vec_id"] for r in neighbours.nearest(few, F.col("vec_id") == 0, most=20).orderBy("rank").collect()] == [2, 1]
    monkeypatch.undo()
    monkeypatch.setattr(neighbours, "_hashes", lambda vectors: 6)
    vectors = rng.standard_normal((3000, 16))
    vectors *= np.where(np.arange(3000) < 1, 100, rng.uniform(0.5, 1, 3000))[:, None] / np.linalg.norm(vectors, axis=1)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got: dict[int, set] = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 60 == 7, most=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(got) == list(range(7, 3000, 60)) and all(len(found) == 20 for found in got.values())
    hits = 0
    for q, found in got.items():
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(found & set(np.argsort(-scores)[:20].tolist()))
    print("recall", hits / (20 * len(got)))
    assert hits / (20 * len(got)) >= 0.95


def test_neighbours_of_extreme_norms(spark):
    vectors = {1: [1e200, 1e200], 2: [1e-200, 0.0], 3: [1.0, 1.0], 4: [-1.0, 0.5], 5: [1e308, -1e308], 6: [5e-324, 0.0], 7: [1e150, 1.0], 8: [0.0, 0.0]}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got: dict[int, list] = {}
    for r in neighbours.nearest(table, F.col("vec_id") > 0, most=20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ids = [i for i in vectors if i != 8]
    assert sorted(got) == ids
    for q, found in got.items():
        with np.errstate(all="ignore"):
            scores = {i: float(np.einsum("d,d->", np.array(vectors[q]), np.array(vectors[i]))) for i in ids if i != q}
        ranked = sorted(scores, key=lambda i: (np.inf if np.isnan(scores[i]) else -scores[i], i))
        assert [i for i, _ in found] == ranked
        assert all(s == scores[i] or np.isnan(s) and np.isnan(scores[i]) for i, s in found)


# --- 5, 9 repeats --------------------------------------------------------------------

@pytest.mark.parametrize("length", [3, 12, 50])
def test_repeated_words(spark, length):
    rows = plain.documents()
    got = substring_dedup.remove_repeats(spark, plain.table(spark, rows), scratch_folder(spark, "t"), length).collect()
    assert len(got) == len(rows)
    assert by_id(got, "n_words", "n_removed", "kept") == plain.kept_words(rows, length)
    assert all(r["n_removed"] == sum(b - a for a, b in r["spans"]) for r in got)
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)


def test_repeated_words_with_split_shards(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_BLOCKS", 2)
    rng = random.Random(1)
    passage = plain.words(rng, 40)
    rows = [(i, " ".join(plain.words(rng, 9) + passage[:rng.randrange(10, 40)] + plain.words(rng, 9))) for i in range(40)]
    got = substring_dedup.remove_repeats(spark, plain.table(spark, rows), scratch_folder(spark, "t"), 12).collect()
    assert by_id(got, "n_words", "n_removed", "kept") == plain.kept_words(rows, 12)


@pytest.mark.parametrize("length", [40, 200])
def test_repeated_bytes(spark, length):
    rows = plain.documents()
    got = suffix_array.remove_repeats(spark, plain.table(spark, rows), scratch_folder(spark, "t"), length).collect()
    assert len(got) == len(rows)
    found = {d: (n, r, len(s), bytes(k)) for d, (n, r, s, k) in by_id(got, "n_bytes", "n_removed", "spans", "kept").items()}
    assert found == plain.kept_bytes(rows, length)


def test_repeats_of_empty_tables(spark):
    empty = plain.table(spark, [(1, "a")]).limit(0)
    assert substring_dedup.remove_repeats(spark, empty, scratch_folder(spark, "t")).count() == 0
    assert suffix_array.remove_repeats(spark, empty, scratch_folder(spark, "t")).count() == 0


def test_ranks_follow_the_order(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(30), rng.randrange(4)) for i in range(500)]
    table = spark.createDataFrame(rows, "i int, a long, b long").repartition(7)
    got = suffix_array.rank(table, "a", "b").collect()
    times = {(a, b): sum((x, y) == (a, b) for _, x, y in rows) for _, a, b in rows}
    order = sorted({(r["a"], r["b"]) for r in got})
    ranks = {(r["a"], r["b"]): r["rank"] for r in got}
    assert [ranks[k] for k in order] == sorted(set(ranks.values())) and len(set(ranks.values())) == len(order)
    assert all(r["alone"] == (times[r["a"], r["b"]] == 1) for r in got)


def test_automaton_knows_first_documents():
    automaton = substring_dedup.SuffixAutomaton()
    automaton.add([1, 2, 3, 4, 1, 2, 3], 5)
    automaton.add([2, 3, 4, 9], 8)
    assert automaton.first_documents([7, 1, 2, 3, 4, 9], 3) == [None, 5, 5, 8]
    assert automaton.first_documents([1], 3) == []


# --- 6 tokens ------------------------------------------------------------------------

def test_tokens_equal_the_other_library(spark):
    tokens = byte_bpe.read_ranks(byte_bpe.default_vocabulary())
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                              special_tokens={})
    rows = plain.documents() + [(200, "日本語 text\x1c\x85 ½٣ 🙂🙂x"), (201, "it's WE'LL  \n\n  x"), (202, "\0▁a ▁▁"), (203, "é" * 3000)]
    got = byte_bpe.decode(byte_bpe.encode(plain.table(spark, rows))).withColumn("n", byte_bpe.n_tokens("ids")).collect()
    assert len(got) == len(rows)
    found = {(r["doc_id"], bytes(r["decoded"]).decode()): np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in got}
    for d, t in rows:
        assert found[d, t or ""] == other.encode_ordinary(t or "")
    assert all(r["n"] * 4 == len(r["ids"]) for r in got)
    assert byte_bpe.encode(plain.table(spark, rows).limit(0)).count() == 0


def test_substring_tables_go_when_the_next_one_is_there(spark):
    text, place = " ".join(plain.words(random.Random(5), 80)), scratch_folder(spark, "t")
    found = substring_dedup.repeated_windows(spark, plain.table(spark, [(1, text), (2, "x " + text)]), place, 50)
    assert {r["key"] for r in found.collect()} == {2}
    assert {p.name for p in Path(place.removeprefix("file:")).iterdir()} == {"windows"}


def test_packed_lists_are_read_as_they_were(spark):
    codes, bucket = np.arange(10, dtype=np.uint64), np.array([2, 0, 2, 2, 0, 7, 7, 0, 2, 2], np.int32)
    made = lm_score._lists(bucket, 1, codes=codes, rows=codes.astype(np.uint16))
    assert made.schema.field("codes").type == pa.binary()
    got = [(b, k, c.tolist(), r.view(np.uint16).tolist()) for b, k, (c, r) in lm_score._bucket_rows([made], codes=np.uint64, rows=None)]
    assert got == [(0, 1, [1, 4, 7], [1, 4, 7]), (2, 1, [0, 2, 3, 8, 9], [0, 2, 3, 8, 9]), (7, 1, [5, 6], [5, 6])]


# --- 7 near copies ---------------------------------------------------------------------

@pytest.mark.parametrize(("words", "percent"), [(4, 80), (5, 80), (1, 50)])
def test_near_copies(spark, words, percent):
    rows = plain.documents()
    got = hyperminhash.near_duplicates(spark, plain.table(spark, rows), scratch_folder(spark, "t"), words, percent).collect()
    assert len(got) == len(rows)
    wanted = plain.classes(rows, words, percent)
    found = by_id(got, "n_shingles", "component_id")
    if percent == 80:
        assert found == wanted
    else:  # bands are made for 0.8; below, classes may be missed but never joined wrongly
        assert all(wanted[d][1] == wanted[c][1] for d, (_, c) in found.items())
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)


def test_near_copies_in_a_chain_are_one_class(spark):
    rng = random.Random(7)
    text, rows = plain.words(rng, 100), []
    for i in range(12):
        rows.append((100 - i, " ".join(text)))
        text = list(text)
        text[8 * i] = f"n{i}"
    got = hyperminhash.near_duplicates(spark, plain.table(spark, rows), scratch_folder(spark, "t"), 4, 80).collect()
    assert by_id(got, "n_shingles", "component_id") == plain.classes(rows, 4, 80)


def test_lookalikes_below_the_threshold_are_told_from_copies(spark):
    """Many texts around one template, some linked with it, some just not, and a few linked with each other only."""
    rng = random.Random(11)
    template, rows = plain.words(rng, 120), []
    for i in range(150):
        text = list(template)
        for at in rng.sample(range(len(text)), rng.choice([1, 2, 3, 5, 6, 7, 8])):
            text[at] = f"e{i}x{at}" if i % 3 else f"e{at % 7}"
        rows.append((i, " ".join(text)))
        if i % 10 == 0:  # a copy of a copy
            text[rng.randrange(len(text))] = "again"
            rows.append((1000 + i, " ".join(text)))
    got = hyperminhash.near_duplicates(spark, plain.table(spark, rows), scratch_folder(spark, "t"), 4, 80).collect()
    wanted = plain.classes(rows, 4, 80)
    assert by_id(got, "n_shingles", "component_id") == wanted
    assert 20 < len({c for _, c in wanted.values()}) < 140


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_candidates_from_differences_leave_out_no_link(spark, percent):
    """All pairs of one center that reach the threshold are among the candidates, unless both are linked with it."""
    rng = random.Random(percent)
    center = set(range(60))
    sets = {}
    for key in range(1, 90):
        less = rng.sample(sorted(center), rng.randrange(1, 25))
        more = {rng.choice([100 + rng.randrange(30), 1000 * key + rng.randrange(50)]) for _ in range(rng.randrange(20))}
        sets[key] = (center - set(less)) | more
    near = {k: 100 * len(s & center) >= percent * len(s | center) for k, s in sets.items()}
    rows = [(0, k, 0 if near[k] else k, len(center), len(center - s), len(s - center),
             [*(x + 10**6 for x in center - s), *(x for x in s - center)]) for k, s in sets.items()]
    table = spark.createDataFrame(rows, "center long, key long, of long, n long, less long, more long, differences array<long>")
    got = {tuple(sorted((r["a"], r["b"]))) for r in hyperminhash._candidates(table, percent).collect()}
    linked = {(a, b) for a in sets for b in sets if a < b and not (near[a] and near[b])
              and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert linked <= got and len(got) < len(sets) * (len(sets) - 1) / 2


def test_groups_share_the_node_with_most_links_as_center(spark):
    """A mixed group's center is the hub of the class most of it are in, and not its smallest node."""
    members = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 5, 4), (1, 1, 6, 4), (1, 1, 7, 4), (2, 2, 2, 2), (2, 2, 3, 3)],
                                    "band long, center long, key long, of_key long")
    links = spark.createDataFrame([(4, 6), (5, 6), (6, 7)], "a long, b long")
    classes = spark.createDataFrame([(k, 4) for k in (4, 5, 6, 7)], "key long, class long")
    got = {tuple(r) for r in hyperminhash._around(members, links, classes).collect()}
    assert got == {(6, 1, 1), (6, 5, 4), (6, 7, 4), (2, 3, 3)}


def test_one_id_with_two_texts_is_two_nodes(spark):
    rng = random.Random(3)
    one, two = " ".join(plain.words(rng, 40)), " ".join(plain.words(rng, 40))
    rows = [(1, one), (1, two), (1, one), (2, two + " x"), (3, one + " y"), (0, "a b c d e")]
    got = hyperminhash.near_duplicates(spark, plain.table(spark, rows), scratch_folder(spark, "t"), 4, 80).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == [
        (0, 2, 0, True), (1, 37, 1, True), (1, 37, 1, True), (1, 37, 1, True), (2, 38, 1, False), (3, 38, 1, False)]


def test_estimates_are_corrected(spark):
    rng = np.random.default_rng(3)
    common, a, b = (text_arrays.mix(rng.integers(0, 2**62, n).astype(np.uint64)) for n in (800, 100, 100))
    sets = [np.unique(np.concatenate([common, x])) for x in (a, b)]
    packed = hyperminhash.registers(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    got = hyperminhash.estimate(packed[:1], packed[1:], *(np.array([len(s)]) for s in sets))
    assert abs(got[0] - 0.8) < hyperminhash.MARGIN
    assert 0 < hyperminhash.chance_of_equal(40, 40) < 0.01
    assert hyperminhash.near_duplicates(spark, plain.table(spark, [(1, "a")]).limit(0), scratch_folder(spark, "t")).count() == 0


# --- 8 archives -------------------------------------------------------------------------

def test_archives_hold_every_page(spark):
    rng = random.Random(8)
    pages = [(i, f"http://x/{i}", "<p>" + " ".join(plain.words(rng, rng.randrange(5, 400), 200))) for i in range(60)]
    pages += [(70, "u\r\nInjected: 1", pages[3][2]), (71, None, pages[3][2]), (72, "u", None), (73, "u", ""), (74, "u", "tiny"),
              (75, "u", "tiny"), (76, "u", "é" * 50), (77, "u", "é" * 50), (78, "u", "x\r\n\r\nWARC/1.1\r\n" * 9000),
              (79, "u", pages[4][2]), (79, "u", pages[4][2]), (None, "u", "n" * 200)]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    place = scratch_folder(spark, "warc")
    warc.write_archives(warc.classify(table), place, dictionary=warc.train_dictionary(table), archive_bytes=4000)
    got = warc.read_archives(spark, place).collect()
    assert len(got) == len(pages)
    bodies = {}
    for p, _, h in pages:
        if p is not None and len((h or "").encode()) >= 100:
            bodies.setdefault(h, []).append(p)
    for r in got:
        page = next(p for p in pages if (str(p[0]) if p[0] is not None else None) == r["name"])
        body = (page[2] or "").encode()
        first = min(bodies.get(page[2], [page[0]]), default=None) if page[0] is not None else None
        assert (r["payload_bytes"], r["digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        assert r["record_type"] == ("response" if page[0] == first else "revisit")
        assert r["refers_to"] == (None if page[0] == first else str(first))
        assert r["payload"] is None or bytes(r["payload"]) == body
        assert r["url"] == (None if page[1] is None else page[1].replace("\r", "%0D").replace("\n", "%0A"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(place).collect()
    assert len(files) > 1
    assert all(bytes(f["content"])[:4] == b"\x5d\x2a\x4d\x18" for f in files)
    records = [r for f in files for r in warc.read_records(bytes(f["content"]))]
    assert len(records) == len(pages)


def test_archives_of_few_or_no_pages(spark):
    table = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    for rows in (table, table.limit(0)):
        place = scratch_folder(spark, "warc")
        warc.write_archives(warc.classify(rows), place, dictionary=warc.train_dictionary(rows))
        assert warc.read_archives(spark, place).count() == rows.count()


# --- 10 lines ---------------------------------------------------------------------------

@pytest.mark.parametrize(("edits", "least"), [(0, 12), (2, 8), (3, 5)])
def test_lines_within_a_bound(spark, edits, least):
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(least, least + 6))) for _ in range(12)]
    rows = []
    for i in range(25):
        text = []
        for _ in range(rng.randrange(1, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(edits + 2)):
                at = rng.randrange(len(line))
                line[at:at + rng.randrange(2)] = rng.choice(["", "x", "é"])
            text.append("".join(line))
        rows.append((i, "\n".join([*text, rng.choice(["}", "", " \t", "end"])])))
    got = line_dedup.remove_lines(spark, plain.table(spark, rows), scratch_folder(spark, "t"), least, edits).collect()
    assert by_id(got, "n_lines", "removed", "kept") == plain.kept_lines(rows, least, edits)
    assert len({len(r["removed"]) for r in got}) > 2


@pytest.mark.parametrize("edits", [2, 3])
def test_parts_of_lines_within_the_bound_meet(edits):
    rng = random.Random(edits)
    for _ in range(300):
        line = [rng.choice("ab") for _ in range(rng.randrange(6, 20))]
        other = list(line)
        for _ in range(edits):
            at = rng.randrange(len(other) + 1)
            other[at:at + rng.randrange(2)] = rng.choice(["", "c", "d"])
        spans, begin, length = line_dedup._characters(["".join(line), "".join(other)])
        one, two = line_dedup._part_keys(spans, begin, length, edits)
        assert set(one.tolist()) & set(two.tolist())


def test_short_lines_go_when_they_are_repeated(spark):
    rows = [(1, "Home | About\nHome | Abour\n\n}"), (2, "Home | About\n \n}\n}")]
    got = line_dedup.remove_lines(spark, plain.table(spark, rows), scratch_folder(spark, "t")).collect()
    assert by_id(got, "removed", "kept") == {1: ([], rows[0][1]), 2: ([0, 2, 3], " ")}


def test_lines_within_one_edit(spark):
    rng = random.Random(10)
    lines = [" ".join(plain.words(rng, rng.randrange(2, 9))) for _ in range(25)] + ["ééééé öööö üüüü aaaa"] * 2
    rows = []
    for i in range(30):
        text = []
        for _ in range(rng.randrange(1, 8)):
            line = rng.choice(lines)
            at, kind = rng.randrange(len(line)), rng.randrange(6)
            line = {0: line[:at] + "#" + line[at + 1:], 1: line[:at] + line[at + 1:], 2: line[:at] + "é" + line[at:],
                    3: line + "!", 4: "x" + line[1:]}.get(kind, line)
            text.append(line)
        rows.append((i, "\n".join(text)))
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, "short"), (44, "short"), (45, "long " * 4000), (46, "long " * 4000 + "x"),
             (None, rows[0][1]), (2, rows[2][1])]
    rng.shuffle(rows)
    got = line_dedup.remove_lines(spark, plain.table(spark, rows), scratch_folder(spark, "t"), 12, keep=["source"]).collect()
    assert len(got) == len(rows) and "source" in got[0]
    assert by_id(got, "n_lines", "removed", "kept") == plain.kept_lines(rows, 12)
    assert all(not r["removed"] for r in got if r["doc_id"] is None)
    assert line_dedup.remove_lines(spark, plain.table(spark, rows).limit(0), scratch_folder(spark, "t")).count() == 0
