import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from paperloom.llm import token_files
from paperloom.llm.token_files import PieceEncoder, read_file, read_tokens, write_file, write_tokens

ODD = [
    "", " ", "a", " a", "a ", "a\n", "\na", "a  b", "a\n\nb", "a\tb\r\nc", "x 's 't\n're it's I'll",
    "<|endoftext|> a <|endoftext|>", "aaaa " * 50, "日本語 テキスト\n😀😀 é", "\x00 \x01", "a\xa0b c",
    "one two\nthree four one two\nthree",
]


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def test_pieces_like_whole_texts(vocabulary, library, words):
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = PieceEncoder(file.read())
    texts = ODD + [words(i, 60).replace("a ", "a\n") for i in range(20)] + ODD
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_of_odd_texts_like_the_library(vocabulary, library, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN", 700)  # so that pieces are forgotten on the way
    rng = random.Random(9)
    parts = [" ", " ", "\n", "a", "b.", "it's", "'", "'s", "x1", "9", "é", "e\u0301", "日", ".", ",\n", "ing", " the"]
    parts += ["%%%", "<|endoftext|>", "\t", "\x00", "\u00a0", "I'LL", "'re"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(6000)]
    texts += ["".join(rng.choice(parts[3:17]) for _ in range(9)) for _ in range(4000)]
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = PieceEncoder(file.read())
    got = [x for at in range(0, len(texts), 500) for x in encoder.encode(texts[at : at + 500])]
    expected = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in expected]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 65536, 65537, 200_001])
def test_file_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 50_000, n).astype(np.uint32)
    if n > 5:
        ids[3:5] = [2**32 - 1, 0]
    lengths = np.array([n // 2, 0, n - n // 2])
    data = write_file(np.array([-5, 1, 9]), lengths, ids, bits)
    docs, sizes, back = read_file(data)
    assert docs.tolist() == [-5, 1, 9] and sizes.tolist() == lengths.tolist()
    assert np.array_equal(back, ids)
    with pytest.raises(ValueError):
        read_file(data[:-1] + b"x")


@pytest.mark.parametrize("bits", [False, True])
def test_documents_come_back_in_order(documents, vocabulary, library, words, monkeypatch, bits):
    monkeypatch.setattr(token_files, "FILE_IDS", 500)
    rows = [(1000 - 3 * i, words(i, i % 90), "en", "s") for i in range(120)]
    rows += [(5000 + i, t, None, None) for i, t in enumerate(ODD)]
    rows += [(7, None, "en", "s"), (-4, "negative id", "en", "s"), rows[5], (None, "no id", "", "")]
    rows += [(8, "long " * 3000, "en", "s")]
    files = write_tokens(documents(rows), vocabulary("byte_bpe_50k.json"), end_id=0, bits=bits)
    assert files.count() > 10
    got = sorted(read_tokens(files).collect(), key=lambda r: r["start"])
    ids = [library.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows]
    expected = sorted(zip([r[0] for r in rows], ids), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r["doc_id"] for r in got] == [e[0] for e in expected]
    assert [r["ids"] for r in got] == [e[1] for e in expected]
    start = 0
    for r in got:
        crc = zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(r["ids"]), crc)
        start += len(r["ids"])


def test_empty_table(documents, vocabulary):
    files = write_tokens(documents([]), vocabulary("byte_bpe_50k.json"))
    assert files.count() == 0 and read_tokens(files).count() == 0
