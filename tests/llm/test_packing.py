import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from facetflow.llm import encoding, packing

from .cases import documents, empty, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(
    "text",
    ["", " \n", "a'SB 'S İx", "H̱ é", "a\x1cb \xa0c\x85d²³", "<|endoftext|> b<|ENDOFTEXT|>", "ΑΣ x", "x'll'd''s", "Ǆ ǅ ŉ ß ſ", "###$$$ a12b", "中文 mixed Ünï"],
)
def test_words_are_encoded_like_the_whole_text(tokenizer, text):
    got = np.frombuffer(encoding.WordEncoder(PATH)(text), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_letter_of_the_short_way(tokenizer):
    encode = encoding.WordEncoder(PATH)
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f"A{c}'s", c + c, f"1{c}2", f"!{c}?", f"'{c}", f" {c} ", f"Ɗ{c}"):
            assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_random_texts_of_latin_letters(tokenizer):
    encode, r = encoding.WordEncoder(PATH), random.Random(5)
    for k in range(5000):
        top = 0x250 if k % 2 else 0x180
        text = "".join(chr(r.randrange(0x20, top)) for _ in range(r.randint(1, 14)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_scripts_are_packed(spark, tokenizer):
    rows = [(1, "Ɗan ƙasa"), (2, "®ǮƷ¥ťȁďźȕ¯ưĒ"), (3, "ΑΣ Ж ǅ")]
    pieces = {}
    for r in sorted(packing.pack(documents(spark, rows), PATH).collect(), key=lambda r: r.start):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
    for i, text in rows:
        assert np.frombuffer(pieces[i], "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_a_full_memory_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(encoding, "GENERATION", 3)
    encode = encoding.WordEncoder(PATH)
    for text in ("one two three four five two", "six one six seven"):
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("together", [1, 30, 1 << 20])
def test_texts_cut_together_are_encoded_like_each_alone(tokenizer, monkeypatch, together):
    monkeypatch.setattr(encoding, "TOGETHER", together)
    r = random.Random(together)
    some = ["", "it", "'s", " ", "'", "x'", "reb 'reb'd", "a\n", "\tÉé'll", "ΑΣ", "<|endoftext|>", "w" * 60]
    texts = ["".join(r.choices("ab'stmdrevl \n.é²9", k=r.randrange(9))) + r.choice(some) for _ in range(500)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoding.WordEncoder(PATH).batch(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_different_parts_of_many_texts_are_looked_up_once(tokenizer):
    class Counted(dict):
        asked = 0

        def get(self, part):
            self.asked += 1
            return super().get(part)

    encode = encoding.WordEncoder(PATH)
    encode.young = Counted()
    want = np.array(tokenizer.encode("one two, one.", add_special_tokens=False).ids, "<u4").tobytes()
    assert list(encode.batch(["one two, one."] * 300)) == [want] * 300
    assert encode.young.asked <= 8


@pytest.mark.parametrize("block", [1, 700, 1 << 20])
def test_every_id_lies_in_one_piece(spark, tokenizer, block):
    rows = [(i, t) for i, t in texts() if i is not None]
    out = packing.pack(documents(spark, texts()), PATH, block_tokens=block).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    pieces, sequences, steps = {}, {}, {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
        if r.doc_id is not None:
            assert r.doc_tokens == len(ids[r.doc_id])
            part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
            assert bytes(r.ids) == part and zlib.crc32(part) == zlib.crc32(bytes(r.ids))
            pieces.setdefault(r.doc_id, []).extend(range(r.start, r.start + r.length))
    for i, seen in pieces.items():
        copies = sum(k == i for k, _ in rows)
        assert sorted(seen) == sorted(list(range(len(ids[i]))) * copies)
    assert pieces.keys() == ids.keys()
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0, *(r.length for r in parts)])[:-1])
        total = sum(r.length for r in parts)
        assert total == parts[0].window <= 4096 and total & (total - 1) == 0
        steps.setdefault(parts[0].step, []).append(total)
    assert all(sum(s) <= 8 * 4096 for s in steps.values())


def test_step_groups_are_balanced():
    steps = packing._Steps(4096)
    full = [g for size in (512, 1024, 2048) * 40 for g in steps.add(size, [(0, 0, size)])]
    rest = list(steps.rest())
    totals = {}
    for step, size, _ in [*full, *rest]:
        totals[step] = totals.get(step, 0) + size
    assert len(full) + len(rest) == 120 and sorted(totals.values())[1:] == [4096] * (len(totals) - 1)


def test_gaps_are_filled_from_shorter_pieces():
    pool = packing._Pool()
    for k, n in enumerate([3000, 600, 496, 400, 112]):
        pool.put(n, k, 0)
    windows = list(packing._windows(pool, (512, 1024, 2048, 4096), False))
    assert windows[0] == (4096, [(0, 0, 3000), (1, 0, 600), (2, 0, 496)]) and windows[1] == (512, [(3, 0, 400), (4, 0, 112)])


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
