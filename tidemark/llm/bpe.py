"""BPE encoding and decoding in batched numpy merge rounds.

Texts are cut into words by the tokenizer's pattern; words not met before are encoded together.
Their symbols lie in one flat array. In each round every neighbouring pair is looked up by binary
search in the sorted pair keys, each word takes its lowest rank, and all its pairs of that rank
merge, left to right. Rounds end when no word has a pair left.

The vocabulary file (a tokenizers JSON: byte-level BPE, with or without word ends) is read on the
executors from ``path``, which must name a file that every executor has. Null text is empty and has
no ids; words of any length are encoded whole.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.textkit import slices

CACHED_WORDS = 150_000
ROUND_SYMBOLS = 1 << 20
NO_RANK = np.int64(1 << 40)


@lru_cache(maxsize=2)
def _classes(last: int) -> dict[str, str]:
    """Letters, numbers and white space up to a code point, as character ranges for ``re``."""
    spaces = {0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x20, *range(0x09, 0x0E), *range(0x2000, 0x200B)}
    out = {}
    for name, test in (
        ("L", lambda c: unicodedata.category(chr(c))[0] == "L"),
        ("N", lambda c: unicodedata.category(chr(c))[0] == "N"),
        ("s", lambda c: c in spaces),
    ):
        hits = np.array([c for c in range(last + 1) if test(c)])
        cuts = np.flatnonzero(np.diff(hits) > 1)
        begins, ends = hits[np.append(0, cuts + 1)], hits[np.append(cuts, len(hits) - 1)]
        out[name] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(begins, ends))
    return out


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class BPE:
    """One vocabulary with its rules."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.fold = spec.get("normalizer") is not None  # NFC, white space and lower case
        self.spaced = spec.get("decoder") is None  # decoding joins the tokens by spaces
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # matching is far faster while the classes hold no character above U+FFFF
        self.narrow, self.wide = (re.compile(self._pattern(_classes(last))).findall for last in (0xFFFF, sys.maxunicode))
        shown = _byte_characters()
        self.first = np.array([vocab[x] for x in shown], np.int64)
        self.last = np.array([vocab[x + self.end] for x in shown], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made  # made: by rank
        self.cache: dict[str, bytes] = {}
        names = dict((i, t) for t, i in vocab.items()) | {i: t for t, i in self.special.items()}
        if self.spaced:
            data = [(names[i] + " ").encode() if i in names else b"" for i in range(max(names) + 1)]
        else:
            back = {x: bytes([b]) for b, x in enumerate(shown)}
            plain = {i: t.encode() for t, i in self.special.items()}
            data = [plain.get(i) or b"".join(back[x] for x in names.get(i, "")) for i in range(max(names) + 1)]
        self.sizes = np.array([len(x) for x in data], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(data), np.uint8)

    def _pattern(self, c: dict[str, str]) -> str:
        tails = "'s|'t|'re|'ve|'m|'ll|'d"
        if self.fold:
            return f"{tails}|[{c['L']}]+|[{c['N']}]|[^{c['s']}{c['L']}{c['N']}]+"
        return f"{tails}| ?[{c['L']}]+| ?[{c['N']}]+| ?[^{c['s']}{c['L']}{c['N']}]+|[{c['s']}]+(?![^{c['s']}])|[{c['s']}]+"

    def _merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the symbols of many words; ``word`` is nondecreasing."""
        done_symbols, done_word = [], []
        while len(symbols):
            keys = symbols[:-1] << 20 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where((self.keys[at] == keys) & (word[:-1] == word[1:]), self.ranks[at], NO_RANK)
            rank = np.append(rank, NO_RANK)
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(begin, len(word)))
            lowest = np.minimum.reduceat(rank, begin)
            live = np.repeat(lowest < NO_RANK, counts)
            done_symbols.append(symbols[~live])
            done_word.append(word[~live])
            chosen = (rank == np.repeat(lowest, counts)) & live
            # of neighbouring chosen pairs (a a a) only every other one can merge
            spots = np.flatnonzero(chosen)
            if len(spots):
                head = np.append(True, (np.diff(spots) > 1))
                since = np.arange(len(spots)) - np.maximum.accumulate(np.where(head, np.arange(len(spots)), 0))
                spots = spots[since % 2 == 0]
                symbols = symbols.copy()
                symbols[spots] = self.made[rank[spots]]
                keep = live
                keep[spots + 1] = False
                symbols, word = symbols[keep], word[keep]
            else:
                break
        symbols, word = np.concatenate(done_symbols or [symbols]), np.concatenate(done_word or [word])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _learn(self, fresh: list[str]) -> None:
        """Encode words that the cache lacks."""
        data = [w.encode("utf-8", "surrogatepass") for w in fresh]
        sizes = np.array([len(x) for x in data], np.int64)
        limits = np.cumsum(sizes)
        start = 0
        while start < len(fresh):
            before = limits[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(limits, before + ROUND_SYMBOLS, side="right")))
            raw = np.frombuffer(b"".join(data[start:stop]), np.uint8)
            symbols, own = self.first[raw], sizes[start:stop]
            symbols[np.cumsum(own) - 1] = self.last[raw[np.cumsum(own) - 1]]
            symbols, word = self._merge(symbols, np.repeat(np.arange(len(own)), own))
            ids, ends = symbols.astype("<u4").tobytes(), np.cumsum(np.bincount(word, minlength=len(own))) * 4
            begin = 0
            for w, end in zip(fresh[start:stop], ends.tolist()):
                self.cache[w] = ids[begin:end]
                begin = end
            start = stop

    def _pieces(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if self.fold:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            text = "".join(x.lower() for x in text) if "Σ" in text else text.lower()
        high = not text.isascii() and np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).max() >= 0xF0
        return (self.wide if high else self.narrow)(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts: list[list] = []
        for text in texts:
            if self.splitter is not None and "<|" in text:
                cut = self.splitter.split(text)
                own: list = []
                for i, piece in enumerate(cut):
                    own += [self.special[piece]] if i % 2 else self._pieces(piece)
                parts.append(own)
            else:
                parts.append(self._pieces(text))
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        for number in self.special.values():
            cache[number] = int(number).to_bytes(4, "little")
        fresh = set()
        for own in parts:
            fresh.update(own)
        self._learn([w for w in fresh if w not in cache])
        get = cache.__getitem__
        return [b"".join(map(get, own)) for own in parts]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The text of each list of ids, as UTF-8; what is no valid UTF-8 becomes U+FFFD."""
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        sizes = self.sizes[flat]
        spots = np.repeat(self.starts[flat] - (np.cumsum(sizes) - sizes), sizes)
        spots += np.arange(len(spots))
        data = self.data[spots].tobytes()
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(x) // 4 for x in ids]))].tolist()
        out = [data[a:b] for a, b in zip(ends[:-1], ends[1:])]
        if self.spaced:
            return [x[:-1] for x in out]
        return [x.decode("utf-8", "replace").encode() for x in out]


@lru_cache(maxsize=4)
def load(path: str) -> BPE:
    return BPE(path)


def encoded(batches: Iterator, path: str) -> Iterator[tuple]:
    """Slices of Arrow batches with the ids of their texts."""
    model = load(path)
    for batch in slices(batches):
        yield batch, model.encode([t or "" for t in batch.column("text").to_pylist()])


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` (UTF-8) of every text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch, ids in encoded(batches, path):
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(model.decode(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, ids binary, decoded binary")
