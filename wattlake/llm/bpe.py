"""BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has exactly one token that can end its encoding. The candidates are the vocabulary entries that
are suffixes of the prefix (an automaton finds them in one pass); the right one is compatible with the last token of
what it leaves. Back-pointers from the whole word then spell the ids. No merges are carried out.

For vocabularies with an end-of-word suffix, lower-cased input and one token per merge (``word_bpe_49k.json``).

- A null or empty text has no tokens. Special tokens in a text are found before anything else. What is a letter, and what
  its lower case, is asked of the tokenizer's own normaliser and pattern.
- Texts and words may have any length: time is linear. Words of up to ``CACHED_CHARS`` are remembered, up to
  ``CACHED_WORDS`` of them, so a worker's memory is bounded.
- One row per input row; ids may repeat or be null, other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from wattlake.llm.common import batches_of, byte_names, id_and_text, rows

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CACHED_CHARS = 64
CACHED_WORDS = 400_000
#: The first combining mark.
LATIN = 0x300


class _Shapes(dict):
    """A stand-in for every character beyond ASCII: a letter, a number, another sign or a space.

    Python, its libraries and the tokenizer go by different versions of Unicode, so the tokenizer's own pattern says what a
    character is, when it is met for the first time.
    """

    def __init__(self, pattern: str):
        super().__init__((k, k) for k in range(128))
        self._split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)

    def __missing__(self, code: int) -> str:
        pieces = [p for p, _ in self._split.pre_tokenize_str(f"a{chr(code)}{chr(code)}")]
        # a letter goes on with the one before it, a number stands alone, other signs stand together, a space is nothing
        shape = self[code] = {3: "1", 2: "-", 1: "a" if len(pieces[0]) == 3 else " "}[len(pieces)]
        return shape


class PrefixBpe:
    """Encoder and decoder over one vocabulary file."""

    END = "</w>"

    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["end_of_word_suffix"] != self.END:
            raise ValueError("the vocabulary marks no word ends")
        self.ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self._names = byte_names()
        self.pairs: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        #: When a token is made: bytes first, then merges by rank.
        self.rank = dict.fromkeys(self.tokens, -1)
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            if made in self.halves:
                raise ValueError(f"two merges make {a + b!r}")
            self.pairs[left, right], self.halves[made], self.rank[made] = made, (left, right), rank
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            spelt = self._spelt(token)
            self.automaton.add_word(spelt, (i, len(spelt)))
        self.automaton.make_automaton()
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._normalizer = Tokenizer.from_file(path).normalizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._shapes = _Shapes(pattern)
        self._words = regex.compile(pattern, regex.ASCII)
        # below the first combining mark characters stand for themselves, so one table lowers and one pattern splits
        self._lower = {k: self._normalizer.normalize_str(chr(k)) for k in range(LATIN)}
        plain = sorted({c for low in self._lower.values() for c in low if c > "\x7f"})
        of = {shape: "".join(re.escape(c) for c in plain if self._shapes[ord(c)] == shape) for shape in "a1"}
        self._latin_words = re.compile(pattern.replace(r"\p{L}", f"a-zA-Z{of['a']}").replace(r"\p{N}", f"0-9{of['1']}"), re.ASCII)
        self._latin = re.compile(rf"[\0-\u{LATIN - 1:04x}]*").fullmatch
        self._compatible: dict[tuple[int, int], bool] = {}
        self._word_ids: dict[str, list[int]] = {}
        self._known: dict[str, tuple[int, str, str]] = {}

    def _spelt(self, token: str) -> str:
        """One character per byte; the last byte of a word is a character of its own."""
        return token if not token.endswith(self.END) else token[:-5] + chr(ord(token[-5]) + 0x1000)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` gives back ``a, b``.

        Both tokens are taken apart, the later merge first, while no merge across the seam would have come earlier.
        """
        known = self._compatible.get((a, b))
        if known is None:
            if len(self._compatible) > 2 * CACHED_WORDS:
                self._compatible.clear()
            known = self._compatible[a, b] = self._test(a, b)
        return known

    def _test(self, a: int, b: int) -> bool:
        rank, halves, left, right = self.rank, self.halves, a, b
        bound, right_first = len(self.rank), False
        while True:
            made = self.pairs.get((left, right))
            if made is not None and (rank[made] < bound or rank[made] == bound and right_first):
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            # a merge on the left at the same rank comes first, so ties go to the right part
            if rank[left] > rank[right]:
                bound, right_first = rank[left], False
                left = halves[left][1]
            else:
                bound, right_first = rank[right], True
                right = halves[right][0]

    def word_ids(self, spelt: str) -> list[int]:
        """Ids of one word, given as one character per byte."""
        last: list[tuple[int, int]] = [(-1, 0)] * (len(spelt) + 1)
        for end, (token, size) in self.automaton.iter(spelt):
            start = end + 1 - size
            before = last[start][0]
            if (start == 0 or before >= 0 and self.compatible(before, token)) and last[end + 1][0] < 0:
                last[end + 1] = (token, start)
        ids, at = [], len(spelt)
        while at:
            token, at = last[at]
            if token < 0:
                raise ValueError("a prefix has no last token")
            ids.append(token)
        return ids[::-1]

    def _word(self, word: str) -> list[int]:
        spelt = "".join([self._names[b] for b in word.encode()])
        ids = self.word_ids(spelt[:-1] + chr(ord(spelt[-1]) + 0x1000))
        if len(word) <= CACHED_CHARS:
            if len(self._word_ids) >= CACHED_WORDS:
                self._word_ids.clear()
            self._word_ids[word] = ids
        return ids

    def _chunk_ids(self, chunk: str) -> list[int]:
        """Ids of a stretch without spaces."""
        ids = []
        for part in self._split.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                ids.append(self.special[part])
                continue
            if part.isascii():
                words = self._latin_words.findall(part.lower())
            elif self._latin(part):
                words = self._latin_words.findall(part.translate(self._lower))
            else:
                part = self._normalizer.normalize_str(part)
                words = [part[slice(*m.span())] for m in self._words.finditer(part.translate(self._shapes))]
            for word in words:
                ids += self._word_ids.get(word) or self._word(word)
        return ids

    def _chunk(self, chunk: str) -> tuple[int, str, str]:
        """Number of tokens, ids and tokens as text."""
        ids = self._chunk_ids(chunk)
        made = len(ids), " ".join(map(str, ids)), " ".join([self.tokens[i] for i in ids])
        if len(chunk) <= CACHED_CHARS:
            if len(self._known) >= CACHED_WORDS:
                self._known.clear()
            self._known[chunk] = made
        return made

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self._chunks(text) if ids for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """As the file's missing decoder has it: tokens joined by spaces."""
        return " ".join([self.tokens[i] for i in ids])

    def _chunks(self, text: str) -> list[tuple[int, str, str]]:
        known, chunk = self._known, self._chunk
        return [known.get(c) or chunk(c) for line in text.split("\n") for c in line.split(" ") if c]

    def digests(self, text: str) -> tuple[int, str, str]:
        parts = [p for p in self._chunks(text) if p[0]]
        ids = hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest()
        decoded = hashlib.sha256(" ".join([p[2] for p in parts]).encode()).hexdigest()
        return sum([p[0] for p in parts]), ids, decoded


def encode(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches):
        bpe = PrefixBpe(path)

        def made():
            for doc_id, text in rows(batches, "doc_id", "text"):
                ids = bpe.encode(text)
                yield doc_id, ids, bpe.decode(ids)

        return batches_of(made(), schema, 256)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, without carrying the ids through the plan."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        bpe = PrefixBpe(path)
        return batches_of(((d, *bpe.digests(t)) for d, t in rows(batches, "doc_id", "text")), schema)

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
