"""Exact token counts of a word-level BPE tokenizer by rank-synchronous merging.

Texts are cut at ASCII white space, which no token of such a tokenizer spans,
and the distinct words of a batch are split into pre-tokens. The distinct
pre-tokens are then held as one ragged numpy array of symbols: in every round
each of them finds the lowest rank among its neighbouring pairs and merges all
occurrences of that pair, from the left, at the same time as all others. A
pre-token without a mergeable pair leaves the array; what is left of it is its
number of tokens. Merging all occurrences at once is the order of the library
because every pair ranks after the merges that make its halves, which is
checked when the file is read. Special strings count as one token each, as the
library's default has it.

Plain words (ASCII and the letters of Latin-1) are lower-cased and split here;
all others pass through the library's own normaliser and pre-tokeniser. Map-side
only: no shuffle, and a task holds one chunk of at most ``CHUNK_BYTES`` of text
(or one longer word) in arrays.

Defined results: null text counts as empty and has no tokens. Null and repeated
ids are counted row by row. An empty table gives an empty result. Columns named
like a result are replaced.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.llm.common import replacing, text_of

LIMIT = 2048
CHUNK_BYTES = 4 << 20
_NONE = np.iinfo(np.int32).max

# The split pattern of the tokenizer file, and the same for plain words.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_PLAIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|\n|[^\t-\r a-z0-9\xdf-\xf6\xf8-\xff]+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves,
    the other bytes, in order, for the characters from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, after = {}, 256
    for b in range(256):
        letters[b] = chr(b if b in visible else after)
        after += b not in visible
    return letters


class RankTable:
    """Merges of a tokenizer file as arrays: pair key -> rank -> merged symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._check(spec)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        born = np.full(self.size, -1, np.int64)             # rank of the merge that makes a symbol
        if len(np.unique(made)) < len(made):
            raise ValueError("two merges make the same symbol")
        born[made] = np.arange(len(made))
        if (np.maximum(born[left], born[right]) >= np.arange(len(made))).any():
            raise ValueError("a merge ranks before one that makes its half")
        key = left * self.size + right
        order = np.argsort(key)
        self.keys, self.rank_of, self.made = key[order], order.astype(np.int32), made
        letters = byte_letters()
        self.inside = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int32)

    @staticmethod
    def _check(spec: dict) -> None:
        model, added = spec["model"], spec["added_tokens"]
        plain = (model["type"] == "BPE" and not model["dropout"] and not model["ignore_merges"]
                 and not model["continuing_subword_prefix"] and model["end_of_word_suffix"])
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        plain = plain and steps == ["NFC", "Replace", "Lowercase"] and split["pattern"] == {"Regex": SPLIT_PATTERN}
        plain = plain and level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
        if not plain or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
                            or re.search(r"\s", t["content"]) for t in added):
            raise ValueError("not a word-level byte BPE file of the known form")

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], _NONE)

    def count(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence after merging; ``data`` holds the bytes
        of all sequences (none empty), ``lens`` how many each has."""
        out = np.zeros(len(lens), np.int64)
        for ids, left, _ in self._rounds(data, lens):
            out[ids] = left
        return out

    def merge(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left, of all sequences in turn, and how many each has."""
        out, done = np.zeros(len(lens), np.int64), []
        for ids, left, sym in self._rounds(data, lens):
            out[ids] = left
            done.append((ids, left, sym))
        starts = np.cumsum(out) - out
        flat = np.zeros(int(out.sum()), np.int32)
        for ids, left, sym in done:
            flat[np.repeat(starts[ids] - (np.cumsum(left) - left), left) + np.arange(len(sym))] = sym
        return flat, out

    def _rounds(self, data: np.ndarray, lens: np.ndarray):
        """Merge in rounds; yields sequences without a mergeable pair as they
        leave: their places, lengths and symbols."""
        if not len(lens):
            return
        sym, ends = self.inside[data], np.cumsum(lens) - 1
        sym[ends] = self.last[data[ends]]
        rank = np.full(len(sym), _NONE, np.int32)
        rank[:-1] = self.ranks(sym[:-1], sym[1:])
        rank[ends] = _NONE
        ids, lens = np.arange(len(lens)), lens.astype(np.int64)
        while True:
            low = np.minimum.reduceat(rank, np.cumsum(lens) - lens)
            live = low < _NONE
            if not live.all():
                stay = np.repeat(live, lens)
                yield ids[~live], lens[~live], sym[~stay]
                sym, rank, ids, lens, low = sym[stay], rank[stay], ids[live], lens[live], low[live]
            if not len(ids):
                return
            at = np.flatnonzero(rank == np.repeat(low, lens))
            # a run of neighbours is one symbol repeated: every other pair merges, from the left
            first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            within = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
            at = at[within % 2 == 0]
            sym[at] = self.made[rank[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            seq = np.searchsorted(np.cumsum(lens), at, side="right")
            lens = lens - np.bincount(seq, minlength=len(lens))
            sym, rank, at = sym[stay], rank[stay], at - np.arange(len(at))
            ends = np.cumsum(lens) - 1
            rank[at] = self.ranks(sym[at], sym[np.minimum(at + 1, len(sym) - 1)])
            before = at[at > 0] - 1
            rank[before] = self.ranks(sym[before], sym[before + 1])
            rank[ends] = _NONE


def ragged_take(flat: np.ndarray, lens: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``take`` of a ragged array, in turn, and their lengths."""
    got = lens[take]
    starts = (np.cumsum(lens) - lens)[take]
    return flat[np.repeat(starts - (np.cumsum(got) - got), got) + np.arange(int(got.sum()))], got


class WordCounter:
    """Token counts of white-space separated words."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.library, self.table = Tokenizer.from_file(path), RankTable(path)
        self.bytes_of = {ord(c): b for b, c in byte_letters().items()}
        self.special_ids = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        special = sorted(self.special_ids, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def _other(self, word: str) -> list[bytes]:
        """Pre-tokens of a word by the library's own rules."""
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return [p.translate(self.bytes_of).encode("latin-1") for p, _ in pieces]

    def _split(self, words: list[str]) -> tuple[pa.DictionaryArray, np.ndarray, list[int]]:
        """Pre-tokens of all words as a dictionary array, each one's word, and the
        special tokens met (a special string stands as an empty pre-token)."""
        plain, pieces, owner, special = [], [], [], []
        for i, w in enumerate(words):
            if "<|" in w and self.special.search(w):
                at = 0
                for hit in self.special.finditer(w):
                    got = [*self._other(w[at:hit.start()]), b""]
                    pieces += got
                    owner += [i] * len(got)
                    special.append(self.special_ids[hit[0]])
                    at = hit.end()
                got = self._other(w[at:])
            elif _PLAIN.fullmatch(w):
                plain.append(i)
                continue
            else:
                got = self._other(w)
            pieces += got
            owner += [i] * len(got)
        split = _PLAIN_SPLIT.findall("\n".join([words[i] for i in plain]).lower())
        marks = np.fromiter((p == "\n" for p in split), bool, len(split))
        ours = np.array(plain, np.int64)[np.cumsum(marks)[~marks]] if plain else np.zeros(0, np.int64)
        tokens = pa.concat_arrays([pa.array([p for p in split if p != "\n"], pa.string()).cast(pa.binary()),
                                   pa.array(pieces, pa.binary())]).dictionary_encode()
        return tokens, np.concatenate([ours, np.array(owner, np.int64)]), special

    def _merged(self, distinct: pa.Array, merge):
        """``merge`` over the distinct pre-tokens that have bytes, and which have."""
        lens = pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        some = lens > 0
        return merge(np.frombuffer(b"".join(distinct.to_pylist()), np.uint8), lens[some]), some

    def count(self, words: list[str]) -> np.ndarray:
        """How many tokens each word has."""
        tokens, owner, _ = self._split(words)
        found = np.zeros(len(words), np.int64)
        if len(tokens):
            got, some = self._merged(tokens.dictionary, self.table.count)
            each = np.ones(len(some), np.int64)                 # a special string is one token
            each[some] = got
            np.add.at(found, owner, each[tokens.indices.to_numpy()])
        return found

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' token ids in turn, and how many each word has."""
        tokens, owner, special = self._split(words)
        found = np.zeros(len(words), np.int64)
        if not len(tokens):
            return np.zeros(0, np.int32), found
        (flat, got), some = self._merged(tokens.dictionary, self.table.merge)
        lens = np.ones(len(some), np.int64)
        lens[some] = got
        if not some.all():                                      # room for the special token
            flat = np.insert(flat, (np.cumsum(lens) - lens)[~some], -1)
        order = np.argsort(owner, kind="stable")
        flat, each = ragged_take(flat, lens, tokens.indices.to_numpy()[order])
        np.add.at(found, owner[order], each)
        flat[flat < 0] = special            # words with special strings keep their order
        return flat, found


_COUNTERS: dict[str, WordCounter] = {}


def word_counter(path: str) -> WordCounter:
    """Loaded once per worker process; it holds the file's tables and no texts."""
    if path not in _COUNTERS:
        _COUNTERS[path] = WordCounter(path)
    return _COUNTERS[path]


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES):
    """Cut a binary column into lists of (row, bytes) of about ``limit`` bytes; a
    longer text is cut at white space (inside a word only if it has none)."""
    held, size = [], 0
    for row in range(len(texts)):
        view = texts[row].as_buffer()
        data, at = memoryview(view) if view is not None else memoryview(b""), 0
        while len(data) - at > 0:
            end = len(data)
            if end - at > limit:
                space = _SPACE.search(data, at + limit)
                end = space.start() if space else end
            held.append((row, bytes(data[at:end])))
            size, at = size + end - at, end
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _words(held: list[tuple[int, bytes]]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The white-space separated words of a chunk, dictionary-encoded, and their rows."""
    words = pc.ascii_split_whitespace(pa.array([d for _, d in held], pa.large_binary()).cast(pa.large_string()))
    flat = words.flatten()
    rows = np.repeat(np.array([r for r, _ in held], np.int64), np.diff(words.offsets.to_numpy()))
    some = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0           # white space at an end
    return flat.filter(pa.array(some)).dictionary_encode(), rows[some]


def count_tokens(texts: pa.Array, counter: WordCounter, limit: int = CHUNK_BYTES) -> np.ndarray:
    """Tokens of each text of a binary column."""
    out = np.zeros(len(texts), np.int64)
    for held in chunks(texts, limit):
        words, rows = _words(held)
        if len(rows):
            np.add.at(out, rows, counter.count(words.dictionary.to_pylist())[words.indices.to_numpy()])
    return out


def token_ids(texts: pa.Array, counter: WordCounter, limit: int = CHUNK_BYTES):
    """Chunk by chunk: (rows, counts, ids) - the tokens of some rows in turn; a
    text longer than a chunk comes in several."""
    for held in chunks(texts, limit):
        words, rows = _words(held)
        if len(rows):
            flat, lens = counter.ids(words.dictionary.to_pylist())
            ids, each = ragged_take(flat, lens, words.indices.to_numpy())
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            yield rows[first], np.add.reduceat(each, first), ids


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` without its text, plus ``n_bytes, n_tokens`` (long) and
    ``over_limit``: more than ``limit`` tokens."""
    rest = replacing(docs, "n_bytes", "n_tokens", "over_limit").drop(text).columns
    src = docs.select(*rest, text_of(text).cast("binary").alias("_t_text"))
    src = src.withColumn("n_bytes", F.octet_length("_t_text").cast("long"))
    schema = T.StructType([src.schema[c] for c in rest] + [T.StructField("n_bytes", T.LongType()),
                                                           T.StructField("n_tokens", T.LongType())])
    names = [f.name for f in schema]

    def run(batches):
        counter = word_counter(tokenizer)
        for batch in batches:
            texts = batch.column(batch.num_columns - 2)
            kept = [batch.column(i) for i in range(batch.num_columns - 2)]
            n = pa.array(count_tokens(texts, counter))
            yield pa.RecordBatch.from_arrays([*kept, batch.column(batch.num_columns - 1), n], names=names)

    return src.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
