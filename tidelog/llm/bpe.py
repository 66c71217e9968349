"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

A leaf holds the rank of the pair that begins at its position, with the position as its low digits, so the root is the
leftmost pair of lowest rank. A merge changes three leaves, each in a logarithmic number of steps; at an empty root the
word is done. The words of a chunk are merged together, a row of one array each; long words have a tree of their own.

The file is one of the `tokenizers` library: its normalizer, split pattern, added tokens, vocabulary and merges are read
from it. Words are encoded once while they stay in a worker's table of bounded size.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidelog.llm._shared import carried, carried_schema, kept, map_chunks, record, release

_NONE = np.uint32(0xFFFFFFFF)
#: Longer words, in bytes, get a tree of their own.
LONG = 64
#: Words that a worker remembers.
REMEMBERED = 200_000


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Bpe:
    """What a worker needs of one tokenizer file with a byte-level alphabet and word ends.

    Texts with characters that Python's Unicode tables lack are normalised and split by the library itself, whose tables
    may have them; their words are encoded here like all others.
    """

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = spec["normalizer"]["normalizers"] if spec["normalizer"] else []
        self.nfc = any(x["type"] == "NFC" for x in steps)
        self.lower = any(x["type"] == "Lowercase" for x in steps)
        # White space by its Unicode property, as the library's regex engine has it.
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")["pattern"]["Regex"]
        split = split.replace(r"\s", r"\p{White_Space}")
        self.find = regex.compile(split).findall
        self.assigned: set[str] = set()  # characters seen that Python's tables have
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.tokens: list[str] = [""] * (max(*vocab.values(), *self.added.values()) + 1)
        for token, i in [*vocab.items(), *self.added.items()]:
            self.tokens[i] = token
        chars = _byte_chars()
        self.byte = {c: i for i, c in enumerate(chars)}
        self.inner = np.array([vocab[c] for c in chars], np.uint32)
        self.final = np.array([vocab[c + end] for c in chars], np.uint32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.uint32)
        pair = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.uint64)
        order = np.argsort(pair, kind="stable")
        first = np.concatenate(([True], pair[order][1:] != pair[order][:-1]))
        self.pairs, self.ranks = pair[order][first], order[first].astype(np.uint32)
        self.rank_of = dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))
        self.known: dict[str, tuple[str, str, int]] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.uint64) << np.uint64(32)) | b
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == key, self.ranks[at], _NONE)

    def many(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of non-empty words."""
        out: list = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self.one(w)
            elif len(w) == 1:
                out[i] = [int(self.final[w[0]])]
            else:
                by_size.setdefault(1 << (len(w) - 1).bit_length(), []).append(i)
        for width, which in by_size.items():
            ids, count = self._rows([words[i] for i in which], width)
            end = np.cumsum(count).tolist()
            ids, begin = ids.tolist(), 0
            for i, stop in zip(which, end, strict=True):
                out[i] = ids[begin:stop]
                begin = stop
        return out

    def _rows(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """All words of one tree width: the tokens of each, one word after another, and their numbers."""
        n, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
        raw = np.zeros((n, width), np.uint8)
        column = np.arange(width)
        inside = column < size[:, None]
        raw[inside] = np.frombuffer(b"".join(words), np.uint8)
        row = np.arange(n)
        token = self.inner[raw]
        token[row, size - 1] = self.final[raw[row, size - 1]]
        tree = np.full((n, 2 * width), _NONE, np.uint32)
        paired = column[:-1] < (size - 1)[:, None]
        leaf = np.full((n, width - 1), _NONE, np.uint32)
        leaf[paired] = self.rank(token[:, :-1][paired], token[:, 1:][paired])
        tree[:, width : 2 * width - 1] = np.where(leaf == _NONE, _NONE, leaf * np.uint32(width) + column[:-1].astype(np.uint32))
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        alive = inside.copy()

        def put(r: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            at = at + width
            tree[r, at] = value
            while len(at) and at[0] > 1:
                at = at >> 1
                tree[r, at] = np.minimum(tree[r, 2 * at], tree[r, 2 * at + 1])

        def ranked(r: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """The leaf of the pair of the tokens at a and b; none beyond a word's end."""
            ok = b < size[r]
            found = np.full(len(r), _NONE, np.uint32)
            found[ok] = self.rank(token[r[ok], a[ok]], token[r[ok], b[ok]])
            return np.where(found == _NONE, _NONE, found * np.uint32(width) + a.astype(np.uint32))

        live = row[tree[:, 1] != _NONE]
        while len(live):
            best = tree[live, 1]
            at = (best & np.uint32(width - 1)).astype(np.int64)
            token[live, at] = self.merged[best // np.uint32(width)]
            gone = after[live, at]
            then = after[live, gone]
            after[live, at] = then
            alive[live, gone] = False
            more = then < width
            before[live[more], then[more]] = at[more]
            put(live, gone, np.full(len(live), _NONE, np.uint32))
            put(live, at, ranked(live, at, then))
            prior = before[live, at]
            has = prior >= 0
            put(live[has], prior[has], ranked(live[has], prior[has], at[has]))
            live = live[tree[live, 1] != _NONE]
        return token[alive], alive.sum(axis=1)

    def one(self, word: bytes) -> list[int]:
        """A long word, with a tree of its own."""
        n, width = len(word), 1 << (len(word) - 1).bit_length()
        token = [*self.inner[np.frombuffer(word, np.uint8)].tolist()]
        token[-1] = int(self.final[word[-1]])
        none, rank_of, merged = 1 << 62, self.rank_of, self.merged.tolist()
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = rank_of.get((token[i] << 32) | token[i + 1])
            if r is not None:
                tree[width + i] = r * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                value = tree[2 * i] if tree[2 * i] < tree[2 * i + 1] else tree[2 * i + 1]
                if tree[i] == value:
                    break
                tree[i] = value

        while tree[1] != none:
            at = tree[1] % width
            token[at] = merged[tree[1] // width]
            gone = after[at]
            after[at] = then = after[gone]
            put(gone, none)
            token[gone] = -1
            if then < n:
                before[then] = at
                r = rank_of.get((token[at] << 32) | token[then])
                put(at, none if r is None else r * width + at)
            else:
                put(at, none)
            if (prior := before[at]) >= 0:
                r = rank_of.get((token[prior] << 32) | token[at])
                put(prior, none if r is None else r * width + prior)
        return [t for t in token if t >= 0]

    def pieces(self, text: str) -> list[str | int]:
        """Words in order, and ids of added tokens that stand in the text."""
        out: list[str | int] = []
        for part in self.cut(text) if self.cut and any(a in text for a in self.added) else (text,):
            if part in self.added:
                out.append(self.added[part])
                continue
            if not part.isascii() and self._unassigned(part):
                out += self._split_by_library(part)
                continue
            if self.nfc:
                part = unicodedata.normalize("NFC", part)
            if self.lower:  # character by character: a final sigma has no form of its own
                part = part.replace("Σ", "σ").lower()
            out += self.find(part)
        return out

    def _unassigned(self, text: str) -> bool:
        fresh = set(text) - self.assigned
        odd = {c for c in fresh if unicodedata.category(c) == "Cn"}
        self.assigned |= fresh - odd
        return bool(odd)

    def _split_by_library(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text) if self.library.normalizer else text)
        return [bytes(self.byte[c] for c in w).decode() for w, _ in words]

    def learn(self, texts: list[list[str | int]]) -> None:
        """Encode what isn't remembered."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = list({w for t in texts for w in t} - self.known.keys())
        numbers = [w for w in fresh if isinstance(w, int)]
        fresh = [w for w in fresh if isinstance(w, str)]
        for w, ids in [*zip(fresh, self.many([w.encode() for w in fresh]), strict=True), *((i, [i]) for i in numbers)]:
            self.known[w] = (" ".join(map(str, ids)), self.decode(ids), len(ids))

    def encode(self, text: str) -> list[int]:
        found = self.pieces(text)
        self.learn([found])
        return [int(i) for w in found for i in self.known[w][0].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by spaces, as for a file without a decoder."""
        return " ".join([self.tokens[i] for i in ids])


_loaded: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    if path not in _loaded:
        _loaded[path] = Bpe(path)
        release()  # what reading the file took
    return _loaded[path]


def encode(documents: DataFrame, path: str, ids: bool = False, digests: bool = True, keep: list[str] | None = None) -> DataFrame:
    """A row per document: doc_id, n_tokens; with `digests` ids_sha256 and decoded_sha256 of all ids and of the text decoded from them; with `ids` the ids and that text themselves; then the columns named in `keep`.

    Null and empty texts have no tokens and decode to the empty string; texts of any length, and words of any length, are
    encoded whole. An empty table gives an empty one. Rows are independent: repeated rows, null doc_ids
    and other columns, of whatever names, are left as they are.
    """
    source, home = kept(documents, keep)
    kinds = [f"doc_id {source.schema['__id'].dataType.simpleString()}", "n_tokens bigint", *["ids_sha256 string", "decoded_sha256 string"] * digests, *["ids array<int>", "decoded string"] * ids]

    def per_chunk(batch, column):
        bpe = load(path)
        texts = [bpe.pieces(t) for t in column.to_pylist()]
        bpe.learn(texts)
        known = bpe.known
        rows = [[known[w] for w in t] for t in texts]
        joined = [" ".join([x[0] for x in r]) for r in rows]
        decoded = [" ".join([x[1] for x in r]) for r in rows]
        out = {"doc_id": batch.column("__id"), "n_tokens": pa.array([sum([x[2] for x in r]) for r in rows], pa.int64())}
        if digests:
            out |= {k: pa.array([hashlib.sha256(x.encode()).hexdigest() for x in v], pa.string()) for k, v in (("ids_sha256", joined), ("decoded_sha256", decoded))}
        if ids:
            out |= {"ids": pa.array([[int(i) for i in x.split()] for x in joined], pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
        return record(**out, **carried(batch, home))

    return map_chunks(source, per_chunk, ", ".join(kinds) + carried_schema(source, home), "__text", most=1 << 20)
