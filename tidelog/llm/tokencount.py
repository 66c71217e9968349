"""Token counts under a unigram model, with forward scores shared along a trie of pre-tokens.

The corpus's distinct pre-tokens are counted once, in one table in order of their text. A run of that table is a trie
walked in depth order: a node is a prefix that the pre-token before doesn't share. Nodes of one depth are scored together:
the best score of a segmentation that ends there, over all pieces that could be its last one, and that segmentation's
tokens. Terminal nodes give the counts of pre-tokens, which are stored as sorted hash arrays and mapped into memory by
the workers that add them up by document. Pre-tokens are told apart by 64-bit hashes.

The pieces are a public vocabulary's; that isn't trained. Their probabilities are: from 1 / (rank + 1), in `rounds` rounds,
the pieces of the best segmentations of all pre-tokens are counted, each as often as its pre-token occurs, and with one
added to each count they are the next round's probabilities. Weights run back along the trie, so a shared prefix is counted
once as well. A character that is no piece counts as its UTF-8 bytes, at a score of 10 below the least piece, as in common
unigram tokenizers; of equal segmentations the one of the longer last piece wins.
"""

from __future__ import annotations

import math
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._shared import Stages, bounded, chunks, local_path, map_batches, map_groups, new_path, record
from tidelog.llm._words import SPACES, mix, powers, words
from tidelog.llm.lm import Reader, _deal, _narrow, _save, _varint, _varints

#: Longer pre-tokens, in characters, are paths of their own.
LONG = 1024
#: Pre-tokens of one trie; and characters, about.
TRIE, TRIE_CHARACTERS = 50_000, 1 << 20
#: Pre-tokens that a task gathers before it hands them on; bytes of text for each of the shards that merge them, about, and their least number.
GATHERED, SHARD_BYTES, SHARDS = 500_000, 24 << 20, 64
#: Pre-tokens in one hash array, about.
SHARD_ROWS = 1_000_000
ROUNDS = 2
MARK = "▁"
_U = np.uint64


class Unigram:
    """Pieces and the logarithms of their probabilities."""

    def __init__(self, pieces: list[str], scores: np.ndarray | None = None):
        self.pieces = list(dict.fromkeys(pieces))
        self.set(np.log(1 / np.arange(1, len(self.pieces) + 1)) - math.log(math.fsum(1 / (i + 1) for i in range(len(self.pieces)))) if scores is None else scores)
        self.longest = max(map(len, self.pieces))
        keys = np.array([self._hash(p) for p in self.pieces], _U)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> _U(44)).astype(np.int64)] = True
        self.at = {p: i for i, p in enumerate(self.pieces)}

    def set(self, scores: np.ndarray) -> None:
        self.scores, self.unknown = np.append(scores, -np.inf), float(scores.min()) - 10

    @staticmethod
    def _hash(piece: str) -> int:
        code = np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(_U) + _U(1)
        return int(mix(np.array([(code * powers(len(code))[0][: len(code)]).sum()], _U))[0])

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Each hash's piece, or -1."""
        out = np.full(len(h), -1)
        maybe = np.flatnonzero(self.seen[(h >> _U(44)).astype(np.int64)])
        at = np.searchsorted(self.keys, h[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == h[maybe]
        out[maybe[hit]] = self.order[at[hit]]
        return out

    def alone(self, word: str) -> tuple[int, list[int]]:
        """Tokens and pieces of a long pre-token, a trie of one path."""
        n = len(word)
        best, back = [0.0] + [-math.inf] * n, [(0, -1)] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(max(0, end - self.longest), end):
                i = self.at.get(word[begin:end])
                if i is not None and best[begin] + self.scores[i] > best[end]:
                    best[end], back[end] = best[begin] + self.scores[i], (begin, i)
            if word[end - 1] not in self.at and best[end - 1] + self.unknown > best[end]:
                best[end], back[end] = best[end - 1] + self.unknown, (end - 1, -1)
        tokens, used, end = 0, [], n
        while end:
            begin, i = back[end]
            tokens += 1 if i >= 0 else len(word[begin:end].encode())
            used += [i] * (i >= 0)
            end = begin
        return tokens, used

    def run(self, ordered: list[str], weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each pre-token, in order of text and none empty; with weights, also how often each piece is used."""
        used, tokens = np.zeros(len(self.pieces) + 1, np.int64), np.zeros(len(ordered), np.int64)
        short = np.flatnonzero(np.fromiter(map(len, ordered), np.int64, len(ordered)) <= LONG)
        if len(short):
            tokens[short] = self._trie([ordered[i] for i in short.tolist()], None if weight is None else weight[short], used)
        for i in np.setdiff1d(np.arange(len(ordered)), short).tolist():
            tokens[i], pieces = self.alone(ordered[i])
            if weight is not None:
                np.add.at(used, pieces, weight[i])
        return tokens, used[:-1]

    def _trie(self, ordered: list[str], weight: np.ndarray | None, used: np.ndarray) -> np.ndarray:
        size = np.fromiter(map(len, ordered), np.int64, len(ordered))
        start = np.cumsum(size) - size
        code = np.frombuffer("".join(ordered).encode("utf-32-le"), np.uint32)
        up, down = powers(len(code))
        total = np.zeros(len(code) + 1, _U)
        np.cumsum((code.astype(_U) + _U(1)) * up[: len(code)], out=total[1:])
        width = np.where(code < 0x80, 1, np.where(code < 0x800, 2, np.where(code < 0x10000, 3, 4)))
        n, depth = len(ordered), int(size.max())
        # A pre-token's depth of agreement with the one before.
        agree = np.zeros(n, np.int64)
        open_ = np.arange(1, n)
        for d in range(depth):
            open_ = open_[(size[open_] > d) & (size[open_ - 1] > d)]
            open_ = open_[code[start[open_] + d] == code[start[open_ - 1] + d]]
            agree[open_] += 1
        result = np.zeros(n, np.int64)
        # Of each depth: whose node each pre-token's is; by that, its place among the depth's nodes; scores and tokens.
        none = np.zeros(n, np.int64)
        levels = [(none, np.zeros(1), np.zeros(1, np.int64))]
        steps: list[tuple] = []
        here = np.arange(n)
        for d in range(1, depth + 1):
            here = here[size[here] >= d]
            made = here[agree[here] < d]
            node = np.zeros(n, np.int64)
            node[here] = np.searchsorted(made, here, "right") - 1
            best, count = np.full(len(made), -np.inf), np.zeros(len(made), np.int64)
            length, piece, parent = np.ones(len(made), np.int64), np.full(len(made), -1), np.zeros(len(made), np.int64)
            for k in range(min(d, self.longest), 0, -1):
                at = start[made] + d - k
                i = self.look_up(mix((total[at + k] - total[at]) * down[at]))
                s, step = self.scores[i], 1
                if k == 1:
                    s = np.where(i < 0, self.unknown, s)
                    step = np.where(i < 0, width[at], 1)
                which, past, so_far = levels[-k]
                source = which[made]
                new = s + past[source]
                better = new > best
                best = np.where(better, new, best)
                count = np.where(better, step + so_far[source], count)
                if weight is not None:
                    length[better], piece[better], parent[better] = k, i[better], source[better]
            levels.append((node, best, count))
            levels = levels[-self.longest - 1 :]
            ended = here[size[here] == d]
            result[ended] = count[node[ended]]
            if weight is not None:
                steps.append((length, piece, parent, np.bincount(node[ended], weight[ended], len(made)).astype(np.int64)))
        for d in range(len(steps), 0, -1):
            length, piece, parent, own = steps[d - 1]
            np.add.at(used, piece, own)
            for k in np.unique(length[own > 0]).tolist():
                if k < d:
                    mine = (length == k) & (own > 0)
                    np.add.at(steps[d - 1 - k][3], parent[mine], own[mine])
        return result


def load(path: str) -> list[str]:
    """A sentencepiece file's ordinary pieces, in order of rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


def pretokens(documents: DataFrame, stage: Stages) -> DataFrame:
    """word and n of every distinct pre-token, in order of text within partitions that are ranges of it.

    Tasks hand on their distinct pre-tokens as joined text, a row for each shard of hashes, and a shard merges them.
    """
    texts = documents.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, most = int(max(SHARDS, -(-size // SHARD_BYTES))), GATHERED

    def distinct(held: list[tuple]) -> tuple:
        """Hashes, words (none has a line break) and numbers."""
        h, first, inverse = np.unique(np.concatenate([x[0] for x in held]), return_index=True, return_inverse=True)
        n = np.bincount(inverse, np.concatenate([x[2] for x in held]), len(h)).astype(np.int64)
        return h, pa.concat_arrays([x[1] for x in held]).take(pa.array(first)), n

    def gather(batches):
        held, n = [], 0
        for _, column in chunks(batches, most=1 << 20):
            w = words(column, SPACES, fold=False)
            h, first, count = np.unique(w.hash, return_index=True, return_counts=True)
            text = w.data.tobytes()
            held.append((h, pa.array([text[s:e] for s, e in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)], pa.binary()), count))
            n += len(h)
            if n > most:
                held = [distinct(held)]
                n = len(held[0][0])
                if n > most / 2:
                    yield from deal(*held.pop())
                    n = 0
        if n:
            yield from deal(*distinct(held))

    def deal(h, word, n):
        for s, part in _deal((h % _U(shards)).astype(np.int64), shards):
            part = part[pa.compute.sort_indices(word.take(pa.array(part))).to_numpy()]  # neighbours are alike, which compresses
            yield record(shard=pa.array([s], pa.int32()), words=pa.array([b"\n".join(word.take(pa.array(part)).to_pylist())], pa.binary()), n=pa.array([_varint(n[part])], pa.binary()))

    def merge(group: pa.Table) -> pa.Table:
        every = pa.concat_arrays([pa.array(x.split(b"\n"), pa.binary()) for x in group.column("words").to_pylist()]).dictionary_encode()
        n = np.bincount(every.indices, np.concatenate([_varints(x, 1)[0] for x in group.column("n").to_pylist()]), len(every.dictionary))
        return pa.table({"word": every.dictionary.cast(pa.string()), "n": pa.array(n.astype(np.int64))})

    packed = map_batches(texts, gather, "shard int, words binary, n binary")
    found = stage(map_groups(packed.groupBy("shard"), documents.sparkSession, merge, "word string, n bigint"), "distinct")
    return stage(found.repartitionByRange("word").sortWithinPartitions("word"), "pretokens")


def hashes(found: list[str]) -> np.ndarray:
    """As words() has them."""
    pieces = [np.zeros(0, _U)]
    for at in range(0, len(found), 10_000):
        pieces.append(words(pa.array(["\n".join(found[at : at + 10_000])], pa.large_string()), SPACES, fold=False).hash)
    return np.concatenate(pieces)


def _tries(batches):
    """Tables of the pre-tokens of one trie."""
    for batch in batches:
        size = np.cumsum(pa.compute.utf8_length(batch.column("word")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < batch.num_rows:
            to = min(at + TRIE, max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + TRIE_CHARACTERS, "right"))))
            yield batch.slice(at, to - at)
            at = to


def fit(table: DataFrame, pieces: list[str], rounds: int = ROUNDS) -> Unigram:
    """Probabilities of the pieces, from the best segmentations of all pre-tokens. What comes to the driver is a row for each piece."""
    model = Unigram(pieces)
    for _ in range(rounds):
        sent = table.sparkSession.sparkContext.broadcast((model.pieces, model.scores[:-1]))

        def run(batches, sent=sent):
            m, used = Unigram(*sent.value), 0
            for b in _tries(batches):
                used = used + m.run([MARK + x for x in b.column("word").to_pylist()], b.column("n").to_numpy())[1]
            if isinstance(used, np.ndarray):
                some = np.flatnonzero(used)
                yield record(i=pa.array(some), n=pa.array(used[some]))

        counted = map_batches(table, run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
        used = np.zeros(len(model.pieces), np.int64)
        used[counted.column("i").to_numpy()] = counted.column("n").to_numpy()
        model.set(np.log(used + 1) - math.log(used.sum() + len(used)))
        sent.destroy()
    return model


def _store(table: DataFrame, model: Unigram, home: str, shards: int, stage: Stages) -> None:
    sent = table.sparkSession.sparkContext.broadcast((model.pieces, model.scores[:-1]))

    def run(batches):
        m = Unigram(*sent.value)
        for b in _tries(batches):
            found = b.column("word").to_pylist()
            h, (tokens, _) = hashes(found), m.run([MARK + x for x in found])
            for s, part in _deal((h % _U(shards)).astype(np.int64), shards):
                yield record(shard=pa.array([s], pa.int32()), h=pa.array([h[part].tobytes()], pa.binary()), tokens=pa.array([_varint(tokens[part])], pa.binary()))

    def write(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        h = np.frombuffer(b"".join(group.column("h").to_pylist()), _U)
        tokens = np.concatenate([_varints(x, 1)[0] for x in group.column("tokens").to_pylist()])
        order = np.argsort(h)
        _save(f"{home}/tokens-{shard}", name=h[order], **_narrow(tokens[order], "tokens"))
        return pa.table({"n": pa.array([len(h)], pa.int64())})

    stage(map_groups(map_batches(table, run, "shard int, h binary, tokens binary").groupBy("shard"), table.sparkSession, write, "n bigint"), "stored")
    sent.destroy()


def token_counts(documents: DataFrame, path: str, rounds: int = ROUNDS) -> DataFrame:
    """A row per document: doc_id, n_words (pre-tokens: runs of other than ASCII white space), n_tokens.

    Each pre-token is scored with the word mark before it. Null, empty and blank texts have none, and texts of any length
    count whole. An empty table gives no rows. Rows are independent but for the model, in which repeated rows count each
    time; null doc_ids and other columns, of whatever names, don't matter. The shared folder must be mounted on the
    workers, as the arrays are mapped into memory.
    """
    spark = bounded(documents.sparkSession)
    home = local_path(new_path(spark, "tokens"))
    os.makedirs(home, exist_ok=True)
    with Stages(spark, "pretokens") as stage:
        table = pretokens(documents, stage)
        shards = max(1, -(-table.count() // SHARD_ROWS))
        _store(table, fit(table, load(path), rounds), home, shards, stage)

    def run(batches):
        reader = Reader({"home": home})
        for batch, column in chunks(batches, most=1 << 20):
            w = words(column, SPACES, fold=False)
            h, inverse = np.unique(w.hash, return_inverse=True)
            tokens = np.zeros(len(h), np.int64)
            for s, part in _deal((h % _U(shards)).astype(np.int64), shards):
                tokens[part] = reader.narrow(f"tokens-{s}", "tokens")(np.searchsorted(reader.file(f"tokens-{s}", "name"), h[part]))
            total = np.concatenate(([0], np.cumsum(tokens[inverse])))
            yield record(doc_id=batch.column("doc_id"), n_words=pa.array(w.count), n_tokens=pa.array(total[w.first[1:]] - total[w.first[:-1]]))

    source = documents.select("doc_id", "text")
    return map_batches(source, run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_tokens bigint")
