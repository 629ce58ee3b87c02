"""The pipeline's stages against plain versions, and the registered queries against SQL."""

from __future__ import annotations

import hashlib
import random

import __spark_entry__
import corpus_pipeline
import plain
import pytest
from compare import oracle_connection, spark_rows, sql_rows
from ordervane.llm import line_dedup, oracles, queries
from ordervane.session import scratch_folder
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def _rows() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(12)
    items = [(i, " ".join(plain.words(rng, 20, 4000))) for i in range(4)]
    rows = plain.documents()[:40]
    for i in range(60, 80):
        lines = [" ".join(plain.words(rng, 12)) for _ in range(5)] + ["the same line in all of them"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    for i in range(80, 86):
        words = items[i % 4][1].split()
        words[i % 7] = "other"
        rows.append((i, " ".join(plain.words(rng, 30) + words)))
    rows += [(90, "123 456"), (91, "\n".join(["the same line in all of them"] * 3)), (92, None), (93, ""), (92, None), (None, "some text"),
             (None, " ".join(plain.words(rng, 5)) + " " + items[1][1]), (80, " ".join(plain.words(rng, 50)))]
    return [(*r, "en" if (r[0] or 0) % 2 else None) for r in rows], items


def test_stages_do_what_plain_versions_do(spark):
    rows, items = _rows()
    folder = scratch_folder(spark, "sf")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    plain.table(spark, rows).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, folder)
        assert name == "byte_bpe" or made.columns == docs.columns
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()

    def texts(name):
        return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in out[name])

    lettered = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    assert texts("language_id") == sorted((-1 if d is None else d, t) for d, t, _ in lettered)
    assert all(r["lang"] == "en" for r in out["language_id"])
    least = line_dedup.MIN_CHARS
    cut = plain.kept_lines(lettered, least)
    left = []
    for d, t, _ in lettered:
        _, gone, kept = cut.get(d, (0, [], t))
        if d is None or not gone:
            left.append((d, t))
        elif kept.strip():
            left.append((d, kept))
    assert texts("line_dedup") == sorted((-1 if d is None else d, t) for d, t in left)
    assert all(r["n_chars"] == len(r["text"]) for r in out["line_dedup"])
    # texts of one id are documents of their own, the smaller id stands for a class
    numbered = dict(enumerate(sorted({(d, t) for d, t in left if d is not None})))
    near = plain.classes([(i, t) for i, (_, t) in numbered.items()], 5, 80)
    single = {numbered[i] for i, (_, of) in near.items() if numbered[of][0] == numbered[i][0]} | {(d, t) for d, t in left if d is None}
    assert texts("minhash_near_dedup") == sorted((-1 if d is None else d, t) for d, t in single)
    numbered = dict(enumerate(sorted(single, key=str)))
    leaked = {i for i, _, _ in plain.passages([(i, t) for i, (_, t) in numbered.items()], items, 13, 2, 5)}
    clean = [row for i, row in numbered.items() if i not in leaked]
    assert leaked and texts("benchmark_decontamination") == sorted((-1 if d is None else d, t) for d, t in clean)
    wanted = sorted((-1 if d is None else d, hashlib.sha256(t.encode()).hexdigest()) for d, t in clean)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["decoded_sha256"]) for r in out["byte_bpe"]) == wanted


def test_short_lines_stay_when_a_shared_footer_goes(spark):
    footer = "the same line at the end of all of them"
    rows = [(1, f"one\n{footer}"), (2, f"roses are red\n\nviolets blue\n{footer}"), (3, f" \n\t\n{footer}\n"), (4, footer),
            (5, "short"), (6, " "), (7, None), (None, footer), (8, f"one\n{footer}\n")]
    got = corpus_pipeline.line_stage(spark, plain.table(spark, rows), FOLDER).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in got} == {
        1: (rows[0][1], len(rows[0][1])), 2: ("roses are red\n\nviolets blue", 27), 5: ("short", 5), 6: (" ", 1), 7: (None, None),
        None: (footer, len(footer))}


def test_texts_with_one_id_are_judged_by_themselves(spark):
    rng = random.Random(5)
    item = " ".join(plain.words(rng, 30))
    one, two = (" ".join(plain.words(rng, 60)) for _ in range(2))
    folder = scratch_folder(spark, "sf")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(1, one), (1, two), (1, one), (2, two + " more"), (3, f"{one} {item}"), (3, two.upper()), (None, f"a b {item}"), (None, one), (None, one)]
    near = corpus_pipeline.near_stage(spark, plain.table(spark, rows), folder)
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in near.collect())
    assert kept == sorted([(1, one), (1, two), (3, rows[4][1]), (0, rows[6][1]), (0, one), (0, one)])
    clean = corpus_pipeline.benchmark_stage(spark, plain.table(spark, rows), folder)
    assert clean.columns == plain.table(spark, rows).columns
    left = sorted((r["doc_id"] or 0, r["text"]) for r in clean.collect())
    assert left == sorted((d or 0, t) for i, (d, t) in enumerate(rows) if i not in (4, 6))


def test_tokens_are_encoded_and_decoded_by_one_python_worker_to_a_task(spark, capsys):
    rows = [(1, "some text"), (1, "some text"), (2, None), (3, ""), (None, "\u00e4 \U0001f600")]
    made = corpus_pipeline.token_stage(spark, plain.table(spark, rows), FOLDER)
    capsys.readouterr()
    made.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    assert sorted((r["doc_id"] or 0, r["decoded_sha256"]) for r in made.collect()) == sorted(
        (d or 0, hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)


def test_stages_take_empty_tables(spark):
    folder = scratch_folder(spark, "sf")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    plain.table(spark, [(1, "a")]).limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_all_operators_are_registered():
    found = __spark_entry__.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in found)] == []
    assert "pipeline" in found and set(queries.QUERIES) >= set(oracles.ORACLES)


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, FOLDER)) == sql_rows(oracle_connection(FOLDER), oracles.ORACLES[name])


def test_pipeline_keeps_what_its_last_stage_returns(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert out.filter(F.octet_length("ids") != 4 * F.col("n_tokens")).isEmpty() and not out.isEmpty()
