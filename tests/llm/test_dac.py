import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from facetflow.llm import dac

from .cases import documents, empty, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("widths", [(8, 8, 8, 8), (32,), (5, 7, 20), (16, 16), (1, 2, 3, 26)])
@pytest.mark.parametrize("top", [1, 3, 300, 70_000, 2**32 - 1])
def test_round_trip_and_random_access(widths, top):
    random = np.random.default_rng(top)
    for n in (0, 1, 63, 64, 65, 512, 513, 5000):
        ids = (top * random.random(n) ** 4).astype(np.uint32)
        if n:
            ids[n // 2] = top
        starts = np.unique(random.integers(0, max(n, 1), 5)) if n else np.array([], int)
        image = dac.Image(dac.encode_image(ids, starts, widths))
        assert image.all().tolist() == ids.tolist()
        at = random.permutation(n)
        assert image.get(at).tolist() == ids[at].tolist()
        assert image.starts.tolist() == [*starts.tolist(), n]


def test_one_place_is_read_without_the_others():
    ids = np.arange(100_000, dtype=np.uint32) * 7919 % 50_000
    image = dac.Image(dac.encode_image(ids, np.array([0])))
    for at in (0, 511, 512, 77_777, 99_999):
        assert image.get(np.array([at])).tolist() == [ids[at]]
    with pytest.raises(IndexError):
        image.get(np.array([100_000]))


def test_broken_input():
    with pytest.raises(ValueError):
        dac.Image(b"DACX" + bytes(40))
    with pytest.raises(ValueError):
        dac.encode_image(np.array([256], np.uint32), np.array([0]), (8,))


def corpus(rows):
    """The documents in order, with their ids, for ids that are unique or have equal texts."""
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [1, 500, 1 << 16])
def test_files_hold_all_documents_in_order(spark, tmp_path, segment):
    rows = [r for r in texts() if r[0] is not None] + [(None, None), (40, "Ɗan ƙasa ®ǮƷ¥ťȁďźȕ¯ưĒ")]
    dac.write_ids(documents(spark, rows), PATH, str(tmp_path / "ids"), segment_ids=segment)
    want = corpus(rows)
    got = dac.read_documents(spark, str(tmp_path / "ids")).collect()
    expected = [(k, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, s, ids in want]
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == expected
    flat = [i for _, _, ids in want for i in ids]
    places = [0, 1, len(flat) // 2, len(flat) - 1, 5, 5, None, len(flat), -1]
    wanted = spark.createDataFrame([(p,) for p in places], "position long")
    found = {r.position: r.token for r in dac.ids_at(spark, str(tmp_path / "ids"), wanted).collect()}
    assert found == {p: flat[p] for p in places if p is not None and 0 <= p < len(flat)}


def test_one_id_of_many_texts_and_repeated_rows(spark, tmp_path):
    rows = [(5, f"text {k % 50}") for k in range(400)] + [(3, "a"), (9, "b")] + [(5, "same")] * 300
    dac.write_ids(documents(spark, rows), PATH, str(tmp_path / "ids"), segment_ids=64)
    got = sorted(dac.read_documents(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [3, *[5] * 700, 9]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(np.array(ids, "<u4").tobytes()) for _, _, ids in corpus(rows))


def test_empty_table(spark, tmp_path):
    dac.write_ids(empty(spark), PATH, str(tmp_path / "ids"))
    assert dac.read_documents(spark, str(tmp_path / "ids")).count() == 0
