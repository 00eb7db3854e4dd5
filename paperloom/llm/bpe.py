"""BPE encoding and decoding in batched numpy merge rounds.

The words of many texts lie in one flat array of symbols. Every round looks up the pairs that
changed by binary search over the sorted pair keys, finds the lowest rank of each word, merges
its occurrences from the left, and retires the words without a pair to merge. Each different
word of a task is encoded once.

The model is a vocabulary file in the format of the tokenizers library: BPE over bytes with an
end-of-word suffix, texts in NFC and lower case, white space dropped. Texts come out with the
ids that library gives.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase, Sequence
from tokenizers.pre_tokenizers import Split

from paperloom.llm.arrow import map_texts

NONE = np.iinfo(np.int32).max  # rank of a pair that has no merge
CACHED_WORDS = 400_000  # different words a task remembers before it starts anew


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in such vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return [
        chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)
    ]


class WordBpe:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, file_text: str) -> None:
        spec = json.loads(file_text)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = np.full(size, "", dtype=object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        characters = byte_characters()
        self.inner = np.array([vocab[c] for c in characters], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in characters], dtype=np.int64)
        self.size = size
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks, self.merged = keys[order], order.astype(np.int32), made
        # Fixed by the format of the vocabulary file.
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.library_words = Split(Regex(pattern), "removed", invert=True)
        self.marks = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        )
        self.known: dict[str, np.ndarray] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; words are not empty."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[flat[ends]]
        owner = np.arange(len(words))  # of the words still in work
        rank = np.full(len(symbols), NONE, dtype=np.int32)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        rank[ends] = NONE
        result: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(rank, starts)
            done = best == NONE
            if done.any():
                for w in np.flatnonzero(done):
                    result[owner[w]] = symbols[starts[w] : starts[w] + lengths[w]]
                busy = np.repeat(~done, lengths)
                symbols, rank = symbols[busy], rank[busy]
                owner, lengths, best = owner[~done], lengths[~done], best[~done]
                if not len(owner):
                    break
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            # In a run of overlapping pairs every second one merges, from the left.
            opens = np.ones(len(at), dtype=bool)
            opens[1:] = at[1:] != at[:-1] + 1
            first = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            # The second symbol of a merged pair goes; its word may have ended with it.
            rank[at] = rank[at + 1]
            stays = np.ones(len(symbols), dtype=bool)
            stays[at + 1] = False
            word = np.repeat(np.arange(len(owner)), lengths)
            lengths = lengths - np.bincount(word[at], minlength=len(owner))
            new = (np.cumsum(stays) - 1)[at]
            symbols, rank, word = symbols[stays], rank[stays], word[stays]
            for i in (new, new[new > 0] - 1):
                i = i[i + 1 < len(symbols)]
                joined = word[i] == word[i + 1]
                i = i[joined]
                rank[i] = self.ranks(symbols[i], symbols[i + 1])
            last = np.cumsum(lengths) - 1
            rank[last] = NONE
        return result

    def split(self, chunk: str) -> list[str]:
        """Words of a piece without white space.

        Beyond the Latin letters the engines' Unicode tables may differ, so there the
        library's own splitter decides.
        """
        if max(chunk) <= "\u024f":
            return self.words.findall(chunk)
        return [w for w, _ in self.library_words.pre_tokenize_str(chunk)]

    def learn(self, chunks: set[str]) -> None:
        """Encode the pieces between white space that are not known yet."""
        if len(self.known) + len(chunks) > CACHED_WORDS:
            self.known = {}
        new = [c for c in chunks if c not in self.known]
        words = [self.split(c) for c in new]
        flat = [w.encode() for ws in words for w in ws]
        ids = iter(self.encode_words(flat)) if flat else iter(())
        for chunk, ws in zip(new, words):
            parts = [next(ids) for _ in ws]
            joined = np.concatenate(parts) if len(parts) != 1 else parts[0]
            self.known[chunk] = joined.astype(np.int32).tobytes()

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Normalized text cut at white space."""
        if not text.isascii():
            # Beyond the Latin letters the library's own Unicode tables decide.
            if BEYOND_LATIN.search(text):
                return [c for c in SPACES.split(LIBRARY_NORMAL.normalize_str(text)) if c]
            text = unicodedata.normalize("NFC", text).lower()
            return [c for c in SPACES.split(text) if c]
        return [c for c in text.translate(ASCII_SPACES).lower().split(" ") if c]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with special tokens found wherever their strings occur."""
        cut: list[list] = []
        for text in texts:
            parts = self.marks.split(text) if "<|" in text else [text]
            cut.append([self.special[p] if p in self.special else self.chunks(p) for p in parts])
        self.learn({c for parts in cut for p in parts if isinstance(p, list) for c in p})
        known = self.known
        out = []
        for parts in cut:
            joined = b"".join(
                np.int32(p).tobytes() if isinstance(p, int) else b"".join([known[c] for c in p])
                for p in parts
            )
            out.append(np.frombuffer(joined, dtype=np.int32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by a space, special tokens included."""
        return " ".join(self.tokens[ids])


BEYOND_LATIN = regex.compile("[^\x00-\u024f]")
LIBRARY_NORMAL = Sequence([NFC(), Lowercase()])
ASCII_SPACES = dict.fromkeys(map(ord, "\t\n\x0b\f\r"), " ")
# White space as the vocabulary's pattern sees it.
SPACES = regex.compile(
    r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)



def encode_texts(
    docs: DataFrame,
    model_file: str,
    text_col: str = "text",
    carry: list[str] | None = None,
    decode: bool = True,
) -> DataFrame:
    """Rows (row, ids array<int>, decoded string): whole texts encoded, and decoded again.

    ``decode`` off leaves the last column out.

    ``model_file`` is read once by the driver and sent to the tasks; it is a vocabulary of
    fixed size. Null and empty texts have no ids and decode to the empty string. ``row`` holds
    the columns of ``carry`` (all for None) whatever their names are.
    """
    with open(model_file, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = [StructField("ids", ArrayType(IntegerType(), False), False)]
    if decode:
        fields.append(StructField("decoded", StringType(), False))

    def prepare():
        bpe = WordBpe(model.value)

        def work(texts: list) -> list[pa.Array]:
            ids = bpe.encode([t or "" for t in texts])
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            made = [lists]
            if decode:
                made.append(pa.array([bpe.decode(i) for i in ids], pa.string()))
            return made

        return work

    return map_texts(docs, text_col, carry, fields, prepare)
