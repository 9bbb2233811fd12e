import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetflow.llm import decontamination, quality, queries, simhash

from .cases import documents, prose
from .test_line_dedup import removed_by_hand


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good and junk documents, copies, near copies, repeated lines, a benchmark passage and awkward rows."""
    path = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(5)
    passage, line = prose(900, 35), prose(901, 60)
    rows, labels = [], []
    for i in range(120):
        good = i % 4 > 0
        text = "\n".join(prose(1000 * i + k, 25).capitalize() + "." for k in range(4)) if good else " | ".join(prose(i, 60).upper().split()) + "!!"
        if good and i % 10 == 1:
            text += f"\n{line}"
        if good and i % 10 == 3:
            text += f"\nBefore {passage} after it."
        rows.append((i, text))
        labels.append((i, int(good), 0))
    for k, i in enumerate((1, 2, 5, 6)):
        rows.append((200 + k, rows[i][1]))
        rows.append((300 + k, rows[i][1].replace(r.choice(rows[i][1].split()), "altered", 1)))
    rows += [(400, None), (401, ""), (None, prose(77, 80)), (2, rows[2][1])]
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def ids_of(df):
    return sorted((r.doc_id for r in df.collect()), key=str)


def test_each_stage_does_its_work_on_all_that_is_left(spark, folder, tmp_path):
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    outputs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        outputs.append(docs)
    good, lines, near, clean, pieces = outputs
    assert all(o.columns == before.columns for o in outputs[:4])

    judged = quality.classify(before, spark.read.parquet(f"{folder}/labels.parquet"))
    assert ids_of(good) == ids_of(judged.where("predicted = 1"))
    assert {i for i in range(120) if i % 4 > 0} <= set(ids_of(good)) and not {i for i in range(0, 120, 4)} & set(ids_of(good))

    rows = [(r.doc_id, r.text) for r in good.collect()]
    unique = list(dict.fromkeys(rows))  # a document is a pair of id and text
    gone = removed_by_hand(unique, 1, 40)
    left = {}
    for k, (i, t) in enumerate(unique):
        kept = [x for n, x in enumerate((t or "").split("\n")) if n not in gone.get(k, [])]
        left[i] = t if not gone.get(k) else "\n".join(kept)
    got = lines.collect()
    assert len(got) == len(rows) and all(r.text == left[r.doc_id] and r.n_chars == (None if r.text is None else len(r.text)) for r in got)

    fp = {r.doc_id: simhash.fingerprint(r.text, 3) for r in got}
    group = {i: i for i in fp}
    for _ in fp:
        for a in fp:
            for b in fp:
                if (fp[a] ^ fp[b]).bit_count() <= 3:
                    group[a] = min(group[a], group[b], key=lambda x: (x is None, x or 0))
        if all(group[group[i]] == group[i] for i in group):
            break
    assert ids_of(near) == sorted(set(group.values()), key=str)

    passage = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    leaks = {r.doc_id for r in near.collect() if " ".join(decontamination.words(passage)) in " ".join(decontamination.words(r.text))}
    assert leaks and ids_of(clean) == sorted(set(ids_of(near)) - leaks, key=str)

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokens = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in clean.collect()}
    packed = {r.doc_id: r.n for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert packed == tokens


def test_one_row_of_each_group_is_kept(spark):
    a, b, c, d = (prose(950 + k, 80) for k in range(4))
    rows = [(1, a), (1, b), (2, a.upper()), (None, c), (None, c.upper()), (None, c), (None, d), (3, d.upper()), (3, d.upper())]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    out = corpus_pipeline.without_near_duplicates(spark, docs, "")
    got = sorted(((r.doc_id, r.text if r.doc_id else r.text.lower()) for r in out.collect()), key=str)
    assert out.columns == docs.columns and got == sorted([(1, a), (1, b), (None, c), (3, d.upper())], key=str)


def test_the_stage_names_and_the_registered_query():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]
    import __spark_entry__

    assert {"pipeline", *(n for n in queries.QUERIES)} <= __spark_entry__.queries().keys()
    assert len(queries.QUERIES) == 10
