import random

import pytest
from tokenizers import Tokenizer

from paperloom.llm.bpe import WordBpe, encode_texts

ODD = [
    None, "", " \n\t", "a", "İSTANBUL ΣΟΦΟΣ ﬁ Å Å", "it's I'LL you'd've 12³½ ⅷ", "x\x1cy\x85q\xa0w",
    "<|endoftext|>Hi<|startoftext|> x<|endof", "日本語テキスト 😀😀 é", "\x00\x01 a\x00b", "ǅ ß ẞ", "aaaa" * 500,
    "a" * 3000 + "b",
]


@pytest.fixture(scope="module")
def path(vocabulary):
    return vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_like_the_library(path, library, words):
    with open(path, encoding="utf-8") as file:
        bpe = WordBpe(file.read())
    rng = random.Random(2)
    texts = [t or "" for t in ODD] + [words(i, 40) for i in range(50)]
    texts += ["".join(rng.choice("aabthe nrs'0.É") for _ in range(60)) for _ in range(500)]
    texts += ["".join(chr(rng.randint(1, 0x2FF)) for _ in range(30)) for _ in range(300)]
    got = bpe.encode(texts)
    for text, ids in zip(texts, got):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text
        assert bpe.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_operator(documents, path, library):
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD)] + [(3, "a", "en", "s"), (None, "b c", "", "")]
    got = encode_texts(documents(rows), path).select("row.doc_id", "row.row", "ids", "decoded").collect()
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows]
    assert [(r["doc_id"], r["ids"]) for r in got] == expected
    assert [r["decoded"] for r in got] == [library.decode(e, skip_special_tokens=False) for _, e in expected]
    assert encode_texts(documents([]), path).count() == 0
