"""Token counts of a byte-level BPE tokenizer by the whole-token shortcut.

Before any text is read, each vocabulary string is tried alone: those that are a
single pre-token and encode as their own single token are proven. A text is split
into pre-tokens; a proven one counts one token without any merging, and only the
rest go through the merges, each distinct one once as long as it is remembered.

The split is the tokenizer's own pattern, found in the bytes of texts of characters
whose classes are known here (ASCII and Latin letters); any other text, and one that
holds a special token's string, is encoded whole by the tokenizer itself. The merges
are the tokenizer's, made for all pre-tokens of one length at a time; long pre-tokens
are encoded by the tokenizer.
"""

import json
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.store import small_batches
from ledgerflow.llm.words import IS_SPACE, flat, slices

# Fixed value: the split pattern of byte-level BPE tokenizers.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PLAIN = re.compile("[\t\n\r -~¡-ſ]*")  # no other white space than space, tab and line ends
SPACE, LETTER, NUMBER, MARK = range(4)
KIND = np.full(256, MARK, dtype=np.uint8)
KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = LETTER
KIND[ord("0"):ord("9") + 1] = NUMBER
KIND[IS_SPACE] = SPACE
# Characters from U+00A0 to U+00BF, by their second byte after 0xC2.
SIGNS = np.full(256, MARK, dtype=np.uint8)
SIGNS[[ord(c) for c in "ªµº"]] = LETTER
SIGNS[[ord(c) for c in "²³¹¼½¾"]] = NUMBER
MOST_KNOWN = 300_000  # pre-tokens whose counts are remembered at a time, besides the proven ones
TAKEN = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
LONGEST = 32  # bytes of a pre-token that is merged here; longer ones are left to the library
NEVER = np.int32(2**31 - 1)  # rank of a pair that is not merged


def pretokens(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of plain texts begin in their bytes; ``starts`` are the texts' own places."""
    kind = KIND[data]
    lead = np.flatnonzero(data == 0xC2)
    kind[lead] = kind[lead + 1] = SIGNS[data[lead + 1]]
    lead = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    kind[lead] = kind[lead + 1] = MARK  # the signs of multiplication and division
    first = np.zeros(len(data) + 1, dtype=bool)
    first[starts] = True
    begins = first[:-1].copy()
    # A run begins where the kind changes, or at the one space before it.
    begins[1:] |= (kind[1:] != kind[:-1]) & (data[:-1] != 0x20)
    # The last of several white spaces goes by itself, or with the run after it.
    begins[1:-1] |= (kind[:-2] == SPACE) & (kind[1:-1] == SPACE) & (kind[2:] != SPACE) & ~first[2:-1]
    # An apostrophe that begins a run takes some letters after it.
    for at in np.flatnonzero(begins & (data == ord("'"))).tolist():
        end = next((k for k in (at + 1, at + 2) if first[k]), at + 3)  # no further than the text
        taken = next((len(t) for t in TAKEN if data[at + 1:end].tobytes().startswith(t)), 0)
        if taken:
            begins[at + 1] = False
            begins[at + 1 + taken:at + 2 + taken] = True
    return np.flatnonzero(begins)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenCounter:
    """Counts tokens as the tokenizer in ``tokenizer_json`` does."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        said = json.loads(tokenizer_json)
        splitter = said["pre_tokenizer"] or {}
        if said["model"]["type"] != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex") or said["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer and prefix space is expected")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.split = regex.compile(SPLIT).findall
        self.special = [t["content"] for t in said["added_tokens"]]
        self._load(said["model"])
        self.proven = self._prove(said["model"]["vocab"])
        self.known = self._shortcut()

    def _load(self, model: dict) -> None:
        """Ranks of the merges, and what they make, where they are plain merges of bytes."""
        vocab, letters = model["vocab"], byte_alphabet()
        special = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        self.merges_bytes = not special and all(c in vocab for c in letters)
        if self.merges_bytes:
            pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
            left, right, made = (np.array([vocab[t] for t in side], dtype=np.int64) for side in (
                [a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
            self.width, self.made = max(vocab.values()) + 1, made
            keys = left * self.width + right
            order = np.argsort(keys, kind="stable")
            self.keys, self.ranks = np.append(keys[order], -1), np.append(order, NEVER).astype(np.int32)
            self.of_byte = np.zeros(256, dtype=np.int64)
            self.of_byte[list(letters.values())] = [vocab[c] for c in letters]
            self.of_bytes = self._rank(self.of_byte[:, None], self.of_byte[None, :])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair among the merges."""
        keys = left * self.width + right
        at = np.searchsorted(self.keys[:-1], keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def _prove(self, vocabulary: dict[str, int]) -> frozenset[str]:
        letters, found = byte_alphabet(), []
        for token, number in vocabulary.items():
            try:
                text = bytes(letters[c] for c in token).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if PLAIN.fullmatch(text) and text not in self.special and self.split(text) == [text]:
                found.append((text, number))
        encoded = self.tokenizer.encode_batch_fast([text for text, _ in found], add_special_tokens=False)
        return frozenset(text for (text, number), e in zip(found, encoded, strict=True) if e.ids == [number])

    def _shortcut(self) -> dict[bytes, int]:
        return dict.fromkeys((p.encode() for p in self.proven), 1)

    def _merge(self, new: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token: its pair of the least rank is merged, the first of such, again and again.

        Rows of one length go together, the longest first; a merge makes a row one shorter.
        """
        sizes = np.zeros(len(new), dtype=np.int64)
        longest = int(lengths.max(initial=1))
        which = np.zeros(0, dtype=np.int64)
        ids, ranks = np.zeros((0, longest), dtype=np.int64), np.zeros((0, longest - 1), dtype=np.int32)
        for length in range(longest, 1, -1):
            own = np.flatnonzero(lengths == length)
            rows = np.frombuffer(b"".join([new[k] for k in own.tolist()]), dtype=np.uint8).reshape(len(own), length)
            which = np.concatenate([which, own])
            ids = np.concatenate([ids, self.of_byte[rows]])
            ranks = np.concatenate([ranks, self.of_bytes[rows[:, :-1], rows[:, 1:]]])
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(ids)), at]
            go = best < NEVER
            sizes[which[~go]] = length
            which, ids, ranks, at, row = which[go], ids[go], ranks[go], at[go], np.arange(int(go.sum()))
            ids[row, at] = self.made[best[go]]
            kept = np.ones(ids.shape, dtype=bool)
            kept[row, at + 1] = False
            ids = ids[kept].reshape(len(row), length - 1)
            kept = np.ones(ranks.shape, dtype=bool)
            kept[row, at] = False
            ranks = ranks[kept].reshape(len(row), length - 2)
            for place, beside in ((at - 1, at > 0), (at, at < length - 2)):  # the pairs with what was made
                r, c = row[beside], place[beside]
                ranks[r, c] = self._rank(ids[r, c], ids[r, c + 1])
        sizes[which] = 1
        sizes[lengths == 1] = 1
        return sizes

    def _sizes(self, new: list[bytes]) -> np.ndarray:
        """Tokens of pre-tokens that are not known."""
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        here = (lengths <= LONGEST) & self.merges_bytes
        sizes = np.zeros(len(new), dtype=np.int64)
        sizes[here] = self._merge([new[k] for k in np.flatnonzero(here).tolist()], lengths[here])
        rest = np.flatnonzero(~here)
        encoded = self.tokenizer.encode_batch_fast([new[k].decode() for k in rest.tolist()], add_special_tokens=False)
        sizes[rest] = [len(e.ids) for e in encoded]
        return sizes

    def _plain(self, column: pa.Array) -> np.ndarray:
        """Tokens of each plain text."""
        data, starts = flat(column)
        if not len(data):
            return np.zeros(len(column), dtype=np.int64)
        begins = pretokens(data, starts)
        bounds = np.append(begins, len(data))
        cut = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        distinct = cut.dictionary.to_pylist()
        if len(self.known) > MOST_KNOWN + len(self.proven):
            self.known = self._shortcut()
        counts = np.fromiter(map(self.known.get, distinct, repeat(0)), np.int64, len(distinct))
        unknown = np.flatnonzero(counts == 0)
        if len(unknown):
            new = [distinct[k] for k in unknown.tolist()]
            counts[unknown] = self._sizes(new)
            self.known.update(zip(new, counts[unknown].tolist(), strict=True))
        upto = np.concatenate([[0], np.cumsum(counts[cut.indices.to_numpy()])])
        return np.diff(upto[np.searchsorted(begins, starts)])

    def count(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text of an Arrow column, null being empty."""
        texts = [t or "" for t in column.to_pylist()]
        plain = np.array([PLAIN.fullmatch(t) is not None and not any(s in t for s in self.special) for t in texts], dtype=bool)
        tokens = np.zeros(len(texts), dtype=np.int64)
        tokens[plain] = self._plain(column.filter(pa.array(plain)))
        for k in np.flatnonzero(~plain).tolist():
            tokens[k] = len(self.tokenizer.encode(texts[k], add_special_tokens=False).ids)
        return tokens

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        return self.count(pa.array(texts, pa.large_string())).tolist()


_counters: dict[str, TokenCounter] = {}


def _count(shared, over: int):
    def run(batches):
        key = shared.value
        if key not in _counters:
            _counters.clear()
            _counters[key] = TokenCounter(shared.value)
        counter = _counters[key]
        for batch in batches:
            for part in slices(batch):
                _, starts = flat(part.column("text"))
                tokens = counter.count(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(starts)), pa.array(tokens), pa.array(tokens > over)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, in one pass without a shuffle.

    Null texts count as empty (no bytes, no tokens). Ids may be null or repeated;
    each row has its own result. Other columns are not read. The tokenizer file is
    read by the driver and broadcast; its size is that of one vocabulary.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    TokenCounter(tokenizer)  # refuses other kinds of tokenizers at once
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_count(shared, limit), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
