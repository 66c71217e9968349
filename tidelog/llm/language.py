"""Language identification by n-gram filters with a bitmask of languages in each place.

A bit-sliced Bloom filter: the words of a table hold a bit for each language, and the languages of an n-gram are those
whose bits are set at all of its places. A document's n-grams are looked up together; for each language the hits are
counted and corrected for the filter's false positives, and the language with the most wins.

An n-gram belongs to a language if it is at least `share` of that language's n-grams of its length in the training texts
and not much rarer there than in another language, so no language has more than 1 / share of them: that bounds what
reaches the driver and is broadcast. Counts are over all training rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._shared import Stages, carried, carried_schema, kept, map_chunks, offsets, record, text_bytes
from tidelog.llm._words import _LOWER, mix

#: Lengths in bytes; an n-gram's length is in its code's top byte.
LENGTHS = (3, 5)
#: The least share of a language's n-grams of one length.
SHARE = 1e-5
#: An n-gram less frequent in a language than this part of its greatest frequency isn't that language's.
RATIO = 0.2
PLACES = 3
UND = "und"
_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of letters and single gaps, and each one's text. Texts are lower-cased in A-Z; other than letters and non-ASCII bytes is a gap."""
    off = offsets(column) - offsets(column)[0]
    raw = _LOWER[text_bytes(column)]
    keep = _LETTER[raw]
    # A gap is kept after a letter only, and each text begins and ends with one.
    n, size = len(column), np.diff(off)
    doc = np.repeat(np.arange(n), size)
    gap = np.zeros(len(raw), bool)
    gap[1:] = keep[:-1] & ~keep[1:] & (doc[1:] == doc[:-1])
    take = keep | gap
    chosen, owner = np.where(keep, raw, 32)[take].astype(np.uint8), doc[take]
    length = np.bincount(owner, minlength=n)
    at = np.arange(len(chosen)) + 2 * owner + 1
    text = np.full(len(chosen) + 2 * n, 32, np.uint8)
    text[at] = chosen
    who = np.repeat(np.arange(n), length + 2)
    codes, owners = [], []
    for k in LENGTHS:
        m = max(0, len(text) - k + 1)
        code = np.full(m, k, _U)
        for j in range(k):
            code = (code << _U(8)) | text[j : m + j]
        ok = who[:m] == who[k - 1 : m + k - 1]
        codes.append(code[ok])
        owners.append(who[:m][ok])
    return np.concatenate(codes), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  #: uint64 words, a row for each place, a column for each 64 languages
    false: np.ndarray  #: each language's rate of false positives


def _places(code: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(code + _U(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> _U(64 - bits)).astype(np.int64) for i in range(PLACES)]


def train(documents: DataFrame, share: float = SHARE, ratio: float = RATIO) -> Model:
    """From text and lang of all rows where lang isn't null; texts of any length count whole, repeated rows each time, and other columns, of whatever names, play no part. No rows give a model without languages."""

    def per_chunk(batch, column):
        langs = batch.column("lang").dictionary_encode()
        code, owner = grams(column)
        which = np.asarray(langs.indices)[owner]
        out = [[], [], []]
        for i, name in enumerate(langs.dictionary.to_pylist()):
            found, count = np.unique(code[which == i], return_counts=True)
            out[0].append(np.full(len(found), i))
            out[1].append(found.view(np.int64))
            out[2].append(count)
        index = pa.array(np.concatenate(out[0]).astype(np.int32)) if out[0] else pa.array([], pa.int32())
        return record(lang=pa.DictionaryArray.from_arrays(index, langs.dictionary).cast(pa.string()), code=pa.array(np.concatenate(out[1]) if out[1] else [], pa.int64()), n=pa.array(np.concatenate(out[2]) if out[2] else [], pa.int64()))

    source = documents.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = map_chunks(source, per_chunk, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # The length stands above the n-gram's own bytes.
    length = F.lit(None)
    for k in LENGTHS:
        length = F.coalesce(length, F.when(F.shiftright("code", 8 * k) == k, k))
    with Stages(documents.sparkSession, "grams") as stage:
        counts = stage(counts.withColumn("k", length), "counts")
        totals = counts.groupBy("lang", "k").agg(F.sum("n").alias("total"))
        shares = counts.join(F.broadcast(totals), ["lang", "k"]).select("lang", "code", (F.col("n") / F.col("total")).alias("p")).filter(F.col("p") >= share)
        rows = shares.toPandas()  # at most 1 / share rows for each language and length
    if ratio > 0 and len(rows):
        rows = rows[rows.p >= ratio * rows.groupby("code").p.transform("max")]
    languages = sorted(rows.lang.unique().tolist()) if len(rows) else []
    bits = max(16, int(max(1, len(rows.code.unique()) if len(rows) else 1) * 8).bit_length())
    table = np.zeros((1 << bits, max(1, -(-len(languages) // 64))), _U)
    false = np.zeros(len(languages))
    for i, name in enumerate(languages):
        code = rows.code[rows.lang == name].to_numpy().view(_U)
        for p in _places(code, bits):
            np.bitwise_or.at(table[:, i // 64], p, _U(1 << (i % 64)))
        false[i] = float(((table[:, i // 64] >> _U(i % 64)) & _U(1)).mean()) ** PLACES
    return Model(languages, table, false)


def predict(documents: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """A row per document: doc_id, lang_pred, score, then the columns named in `keep`.

    score: the part of the document's n-grams that the predicted language has, corrected for false positives, 0 to 1.
    Null texts, texts without letters, and all texts under a model without languages are `und` at score 0. Equal counts
    go to the first language in order of name. Texts of any length are looked up whole. Rows are independent: repeated
    rows and other columns, of whatever names, play no part.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    source, home = kept(documents, keep)
    letter = regex.compile(r"\p{L}")

    def per_chunk(batch, column):
        m = sent.value
        code, owner = grams(column)
        bits = int(len(m.table) - 1).bit_length()
        found = None
        for p in _places(code, bits):
            found = m.table[p] if found is None else found & m.table[p]
        n = np.bincount(owner, minlength=len(column))
        hits = np.zeros((len(column), len(m.languages)))
        for i in range(len(m.languages)):
            hits[:, i] = np.bincount(owner[((found[:, i // 64] >> _U(i % 64)) & _U(1)) == 1], minlength=len(column))
        corrected = np.maximum(0, (hits - n[:, None] * m.false) / (1 - m.false)) if len(m.languages) else np.zeros((len(column), 1))
        best = corrected.argmax(axis=1)
        score = np.clip(corrected[np.arange(len(column)), best] / np.maximum(1, n), 0, 1)
        und = np.fromiter((not m.languages or letter.search(t) is None for t in column.to_pylist()), bool, len(column))
        names = np.array([*m.languages, UND], object)
        best[und] = len(m.languages)
        score[und] = 0
        return record(doc_id=batch.column("__id"), lang_pred=pa.array(names[best], pa.string()), score=pa.array(score), **carried(batch, home))

    return map_chunks(source, per_chunk, f"doc_id {source.schema['__id'].dataType.simpleString()}, lang_pred string, score double{carried_schema(source, home)}", "__text")


def remainder(doc_id: str, of: int):
    """crc32 of a document's id as text, modulo `of`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


def identify(documents: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from those that aren't held out."""
    held = remainder("doc_id", folds) == fold
    model = train(documents.filter(~held))
    named = documents.select("doc_id", "text", held.alias("held"))
    return predict(named, model, keep=["held"]).select("doc_id", F.col("kept_held").alias("held_out"), "lang_pred", "score")
