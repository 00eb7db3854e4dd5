import random
import re
import zlib

import numpy as np
import pyarrow as pa

from paperloom.llm.words import crc32_of_spans, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def odd_texts():
    rng = random.Random(1)
    made = ["".join(rng.choice("aB1 é,ß\n日-") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    return [None, "", "  ", "A b", "É", "x\x00y", "\x7f", "a", "b", "a" * 1000 + " " + "c" * 65, *made]


def test_words_are_those_of_the_pattern():
    texts = odd_texts()
    words = words_of(pa.array(texts))
    assert words.per_text.tolist() == [len(plain_words(t)) for t in texts]
    assert words.array().to_pylist() == [w for t in texts for w in plain_words(t)]
    part = words_of(pa.array(texts)[7:900])
    assert part.array().to_pylist() == [w for t in texts[7:900] for w in plain_words(t)]
    assert words_of(pa.array([], pa.string())).per_text.tolist() == []


def test_crc32_like_the_library():
    words = words_of(pa.array(odd_texts()))
    got = crc32_of_spans(words.data, words.starts[:-1], np.diff(words.starts))
    assert got.tolist() == [zlib.crc32(w.encode()) for w in words.array().to_pylist()]
    for n in [0, 1, 63, 64, 65, 127, 128, 129, 191, 193, 4097, 100_003, 2_000_000]:
        data = np.random.default_rng(n).integers(0, 256, n + 3, dtype=np.uint8)
        found = crc32_of_spans(data, np.array([0, 3]), np.array([n, n]))
        assert found.tolist() == [zlib.crc32(data[:n].tobytes()), zlib.crc32(data[3:].tobytes())]
