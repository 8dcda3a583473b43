"""BPE encoding and decoding for word-end vocabularies, by contiguous rank arrays.

A word is held as the array of its parts and, beside it, the array of the merge
ranks of neighbouring parts.  The least rank is looked for by scanning, its right
part is taken out, and the ranks on both sides are looked up anew, until no rank is
left.  Words are short, so scanning contiguous arrays beats any heap; words are
worked on many at once, one row each, and every distinct one of a run of rows once.

The text pipeline is the vocabulary file's: special tokens are cut out first, then
NFC, white space to one space, lower case, the split pattern, and bytes written in
the byte-level alphabet.  ``encode`` gives the ids without template tokens,
``decode`` the token strings joined by one space (the file names no decoder).

Defined results: a null or empty text has no ids and decodes to the empty text;
ids may be any list; a null list decodes to the empty text; extra columns and
repeated rows pass through unchanged.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm.common import map_arrow, others, table

RUN = 1 << 22           # bytes of text whose distinct stretches are worked out once; a longer text is a run of its own
STRETCHES = 25_000      # stretches split and merged at once
BLOCK = 1 << 18         # parts of words merged side by side
PIECE = 1 << 19         # bytes of text encoded at once; a longer text is a piece of its own


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Merges, pattern and special tokens of a ``tokenizers`` file with word-end BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.end = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        n = max(max(self.vocab.values()), *[t["id"] for t in spec["added_tokens"]]) + 1
        self.tokens = np.full(n, "", object)
        for token, i in self.vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.mark = regex.compile(r"\n|" + split["pattern"]["Regex"])  # words, and the ends of stretches
        alphabet = byte_alphabet()
        self.inner = np.array([self.vocab[c] for c in alphabet], np.int32)
        self.last = np.array([self.vocab[c + self.end] for c in alphabet], np.int32)
        # merges sorted by the key of their pair; ``made`` has the merged id by rank
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([self.vocab[a] * n + self.vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.n, self.keys, self.ranks, self.none = n, key[order], order.astype(np.int32), np.int32(len(pairs))
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each neighbouring pair, ``none`` where it has no merge."""
        key = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge(self, words: pa.Array) -> pa.Array:
        """Ids of every word, as lists; words of one length are worked on side by side."""
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
        size = np.diff(ends)
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order])) + 1
        done: list = []
        for same in np.split(order, cuts):
            length = int(size[same[0]]) if len(same) else 0
            step = max(1, BLOCK // max(1, length))
            for lo in range(0, len(same) if length else 0, step):
                rows = same[lo:lo + step]
                self._block(data[ends[rows][:, None] + np.arange(length)], rows, done)
        count = np.zeros(len(words), np.int64)
        for place, ids in done:
            count[place] = ids.shape[1]
        ends = np.append(0, np.cumsum(count))
        flat = np.empty(ends[-1], np.int32)
        for place, ids in done:
            flat[ends[place][:, None] + np.arange(ids.shape[1])] = ids
        return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat))

    def _block(self, raw: np.ndarray, place: np.ndarray, out: list) -> None:
        """Add (places, ids of each) to ``out``; ``raw`` has the bytes of one word in each row."""
        ids = self.inner[raw]
        ids[:, -1] = self.last[raw[:, -1]]
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        while True:
            # one merge in every row that still has one, so all rows keep one length
            row = np.arange(len(ids))
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            least = ranks[row, at] if ranks.shape[1] else np.full(len(ids), self.none)
            go = least < self.none
            if not go.all():
                out.append((place[~go], ids[~go]))
                ids, ranks, place, at, least = ids[go], ranks[go], place[go], at[go], least[go]
                row = row[:len(ids)]
            if not len(ids):
                return
            ids[row, at] = self.made[least]
            cols = np.arange(ids.shape[1])
            ids = ids[cols != at[:, None] + 1].reshape(len(ids), -1)
            ranks = ranks[cols[:-1] != at[:, None]].reshape(len(ids), -1)
            before = at > 0
            r, c = row[before], at[before] - 1
            ranks[r, c] = self.rank(ids[r, c], ids[r, c + 1])
            after = at < ids.shape[1] - 1
            r, c = row[after], at[after]
            ranks[r, c] = self.rank(ids[r, c], ids[r, c + 1])

    def words(self, chunks: list[str]) -> list[str]:
        """Words of the stretches in order, a line end after each; stretches hold none and no special token."""
        return self.mark.findall(lower(unicodedata.normalize("NFC", "\n".join([*chunks, ""]))))


def lower(text: str) -> str:
    """Lower case character by character (no context rule for a final sigma)."""
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Coded:
    """A column of texts as numbers of distinct stretches, and these stretches' ids."""

    def __init__(self, codes: list[pa.Array], known: pa.Array):
        self.codes, self.known = codes, known

    def ids(self, at: int) -> pa.Array:
        """Ids of every text of the piece ``at``, as lists."""
        lists = self.codes[at]
        got = self.known.take(lists.values)
        ends = np.asarray(got.offsets)
        return pa.ListArray.from_arrays(pa.array(ends[np.asarray(lists.offsets)] - ends[0], pa.int32()), got.flatten())


class Encoder:
    """Encodes text columns; every distinct stretch between spaces is worked out once.

    No word crosses a space or line end, normal forms and lower case do not look
    past one, and a special token is set apart by spaces; so a text is the sequence
    of its stretches.  Nothing is kept from one column to the next: a run of rows
    repeats its common stretches often enough, and rare ones would only fill memory.
    """

    def __init__(self, vocab: Vocabulary, limit: int = STRETCHES):
        self.vocab, self.limit = vocab, limit

    def learn(self, stretches: pa.Array) -> pa.Array:
        """Ids of every stretch, as lists."""
        parts = [self._learn(stretches.slice(lo, self.limit)) for lo in range(0, len(stretches), self.limit)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.large_list(pa.int32()))

    def _learn(self, stretches: pa.Array) -> pa.Array:
        special = pa.array(list(self.vocab.special), pa.large_string())
        which = pc.index_in(stretches, special)
        texts = pc.if_else(pc.is_null(which), stretches, "").to_pylist()
        words = pa.array(self.vocab.words(texts), pa.large_string()).dictionary_encode()
        line_end = pc.index(words.dictionary, "\n").as_py()
        codes = words.indices.to_numpy()
        ends = np.flatnonzero(codes == line_end)
        ids = self.vocab.merge(pc.if_else(pc.equal(words.dictionary, "\n"), "", words.dictionary))
        got = ids.take(pa.array(codes))
        bounds = np.asarray(got.offsets)[np.append(0, ends + 1)]
        out = pa.LargeListArray.from_arrays(pa.array(bounds - bounds[0]), got.flatten())
        if which.null_count == len(which):
            return out
        own = pa.array([[i] for i in self.vocab.special.values()], out.type)
        at = pc.if_else(pc.is_null(which), pa.array(np.arange(len(out)), pa.int64()), pc.add(which.cast(pa.int64()), len(out)))
        return pa.concat_arrays([out, own]).take(at)

    def code(self, texts: pa.Array, cuts: list[tuple[int, int]]) -> Coded:
        """``texts`` coded in the pieces (first row, rows) of ``cuts``."""
        offsets, codes = [], []
        for row, n in cuts:
            part = pc.fill_null(texts.slice(row, n).cast(pa.large_string()), "")
            for special in self.vocab.special:
                part = pc.replace_substring(part, special, f" {special} ")
            lists = pc.split_pattern(pc.replace_substring(part, "\n", " "), " ")
            first = np.asarray(lists.offsets)
            offsets.append(pa.array(first - first[0], pa.int64()))
            codes.append(lists.flatten().dictionary_encode())
        if not codes:
            return Coded([], self.learn(pa.array([], pa.large_string())))
        whole = pa.chunked_array(codes).unify_dictionaries()
        del codes
        known = self.learn(whole.chunk(0).dictionary)
        return Coded([pa.LargeListArray.from_arrays(o, c.indices) for o, c in zip(offsets, whole.chunks)], known)

    def __call__(self, texts: pa.Array) -> pa.Array:
        """Ids of every text, as lists."""
        if not len(texts):
            return pa.array([], pa.list_(pa.int32()))
        return self.code(texts, [(0, len(texts))]).ids(0)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def slices(size: np.ndarray, limit: int):
    """(first row, rows) of runs of rows that hold about ``limit`` in all."""
    total, row = np.cumsum(size), 0
    while row < len(size):
        end = max(row + 1, int(np.searchsorted(total, (total[row - 1] if row else 0) + limit, "right")))
        yield row, end - row
        row = end


def decode_ids(tokens: pa.Array, lists: pa.Array):
    """Decoded text of every id list, piece by piece: (first row, rows, texts)."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for row, n in slices(size, PIECE // 4):
        ends = pa.array(np.concatenate([[0], np.cumsum(size[row:row + n])]), pa.int32())
        text = pa.ListArray.from_arrays(ends, tokens.take(lists.slice(row, n).flatten()))
        yield row, n, pc.binary_join(text, " ")


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """``docs`` with the column ``out`` of token ids and, if named, ``decoded``: the ids' text.

    Other columns with these names, in any case, give way to them.
    """
    new = [out, decoded] if decoded else [out]
    names = others(docs, *new)
    kind = docs.select(*names).withColumn(out, F.lit(None).cast("array<int>"))
    kind = (kind.withColumn(decoded, F.lit("").cast("string")) if decoded else kind).schema

    def run(batches):
        code = encoder(path)
        tokens = pa.array(code.vocab.tokens.tolist(), pa.string())
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
            for start, rows in slices(size, RUN):
                part = batch.slice(start, rows)
                cuts = list(slices(size[start:start + rows], PIECE))
                coded = code.code(part.column(text_col), cuts)
                for piece, (row, n) in enumerate(cuts):
                    some, ids = part.slice(row, n), coded.ids(piece)
                    if not decoded:
                        yield pa.RecordBatch.from_arrays([*some.columns, ids], [*names, out])
                        continue
                    for at, k, text in decode_ids(tokens, ids):
                        yield pa.RecordBatch.from_arrays(
                            [*some.slice(at, k).columns, ids.slice(at, k), text], [*names, out, decoded])
                del coded
                pa.default_memory_pool().release_unused()

    return map_arrow(docs.select(*names), run, kind)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the column ``out`` of decoded texts, in place of any so named; special tokens are kept."""
    names = others(rows, out)
    kind = rows.select(*names).withColumn(out, F.lit("").cast("string")).schema

    def run(batches):
        tokens = pa.array(vocabulary(path).tokens.tolist(), pa.string())
        for batch in batches:
            for row, n, text in decode_ids(tokens, batch.column(ids_col)):
                yield pa.RecordBatch.from_arrays([*batch.slice(row, n).columns, text], [*names, out])

    return map_arrow(rows.select(*names), run, kind)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op3_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or default_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, path, decoded="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """Last pipeline stage: every document that was kept, with its token ids and decoded text."""
    path = path or default_path()
    return encode(docs, path, decoded="decoded")
