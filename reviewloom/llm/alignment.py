"""Alignment of two tokenizers over the same bytes, by as-of merges of token starts."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.registry import query, table
from reviewloom.plans.skew import join_small
from reviewloom.session import scratch_path, tune

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
# bytes of text aligned at once; a longer text is aligned alone
CHUNK_BYTES = 1_000_000
# pairs of ids multiplied out at once, and kept in one stored row
PAIRS_AT_ONCE = 2_000_000
PAIRS_IN_ROW = 100_000
# spans that a task remembers, and their greatest length
REMEMBERED = 200_000
REMEMBERED_CHARS = 32
# id pairs of the corpus that may be broadcast (24 bytes each, also bounded in bytes)
BROADCAST_PAIRS = 600_000
# an id pair is one number: the first id times this, plus the second
PAIR = 1 << 32


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merges_by_rank(definition: bytes) -> bool:
    """Is merging the neighbours of the least joined id first the same as following the list of merges?

    It is when each merge makes the next id, and every entry's bytes, merged by the list, become that entry. For then no
    two neighbours that join to an entry are ever left apart: taken alone, their bytes would have stayed two.
    """
    parsed = json.loads(definition)
    special = {t["content"] for t in parsed.get("added_tokens", [])}
    vocab = {word: i for word, i in parsed["model"]["vocab"].items() if word not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parsed["model"]["merges"]]
    rank = {m: i for i, m in enumerate(merges)}
    letters = sorted(vocab, key=vocab.get)[: len(vocab) - len(merges)]
    made = [vocab.get(a + b) for a, b in merges]
    if sorted(letters) != sorted(byte_letters()) or None in made or made != sorted(set(made)) or (parsed.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        return False
    for word in vocab:
        parts = list(word)
        while len(parts) > 1:
            least, i = min((rank.get(pair, len(rank)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if least == len(rank):
                return False
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return True


class ByteLevel:
    """A byte-level pair-merging definition, with the faster library where :func:`merges_by_rank` allows it.

    Special tokens are plain text either way.
    """

    def __init__(self, definition: bytes, by_rank: bool):
        parsed = json.loads(definition)
        letters = byte_letters()
        special = {t["content"] for t in parsed.get("added_tokens", [])}
        vocab = parsed["model"]["vocab"]
        self.size = max([*vocab.values(), *(t["id"] for t in parsed.get("added_tokens", []))]) + 1
        entries = {bytes(letters[c] for c in word): i for word, i in vocab.items() if word not in special}
        self.bytes = [b""] * self.size
        for word, i in entries.items():
            self.bytes[i] = word
        for t in parsed.get("added_tokens", []):
            self.bytes[t["id"]] = t["content"].encode()
        if by_rank:
            import tiktoken

            ranks = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=entries, special_tokens={})
            self.encode = lambda texts: [ranks.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_str(definition.decode())
            own.no_truncation()
            own.no_padding()
            own.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]


def cut_at_spaces(model: bytes) -> bool:
    """May a text be cut before each run of spaces that follows other text, without changing its pieces?

    It may when texts stay as they are, pieces come from merging neighbours, and no piece holds a space after other text.
    """
    from sentencepiece import sentencepiece_model_pb2

    parsed = sentencepiece_model_pb2.ModelProto.FromString(model)
    kept, kinds = parsed.normalizer_spec, parsed.pieces[0].Type
    return (
        parsed.trainer_spec.model_type == parsed.trainer_spec.BPE
        and not kept.precompiled_charsmap and not kept.remove_extra_whitespaces and kept.escape_whitespaces and kept.add_dummy_prefix
        and "▁" in {p.piece for p in parsed.pieces}
        and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) or "▁" in p.piece.lstrip("▁") for p in parsed.pieces)
    )


class Pieces:
    """A SentencePiece model; it puts a space before a text by itself. Short spans between spaces are encoded once and remembered."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.known: dict[str, list[int]] = {}
        self.cut = re.compile(" +[^ ]*" if cut_at_spaces(model) else "(?s).+").findall

        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = own.get_piece_size()
        self.bytes = []
        for i in range(self.size):
            piece = own.id_to_piece(i)
            one = re.fullmatch("<0x([0-9A-F]{2})>", piece) if own.is_byte(i) else None
            self.bytes.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
        self.own = own

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        spans = [self.cut(t) for t in texts]
        new = list(set().union(*spans).difference(self.known))
        ids = self.own.encode([t[1:] for t in new], num_threads=1)
        # an empty text gets no space by itself
        self.known.update((t, i if t != " " else [self.own.piece_to_id("▁")]) for t, i in zip(new, ids))
        found = [list(chain.from_iterable(map(self.known.__getitem__, s))) for s in spans]
        for t in new:
            if len(t) > REMEMBERED_CHARS:
                del self.known[t]
        return found


class Tokens:
    """Tokens of a run of texts: text number, id, first byte and end byte, in order."""

    def __init__(self, ids: list[list[int]], lengths: np.ndarray):
        self.counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, int(self.counts.sum()))
        self.doc = np.repeat(np.arange(len(ids)), self.counts)
        ends = np.cumsum(lengths[self.ids])
        before = np.append(0, ends)[np.cumsum(self.counts) - self.counts]
        self.end = ends - before[self.doc]
        self.start = self.end - lengths[self.ids]

    def frame(self, name: str) -> pd.DataFrame:
        """Ready for an as-of merge: sorted by text and first byte, which ``at`` joins to one number."""
        return pd.DataFrame({"at": self.doc * PAIR + self.start, "doc": self.doc, name: np.arange(len(self.ids))})


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of all tokens whose byte ranges overlap.

    Of two ranges that overlap, one starts inside the other: each start finds the token of the other side that covers it,
    and the union of both directions is complete. Equal starts are found twice and kept once.
    """
    fa, fb = a.frame("a"), b.frame("b")
    down = pd.merge_asof(fa, fb, on="at", by="doc")
    up = pd.merge_asof(fb, fa, on="at", by="doc", allow_exact_matches=False)
    # a start at byte 0 has no earlier token on the other side
    up = up[up["a"].notna().to_numpy()]
    up_a, up_b = up["a"].to_numpy(np.int64), up["b"].to_numpy(np.int64)
    # an end before the start means that the covering token is the one that starts with it, found on the way down
    inside = a.end[up_a] > b.start[up_b]
    down_a, down_b = down["a"].to_numpy(np.int64), down["b"].to_numpy(np.int64)
    return np.concatenate([down_a, up_a[inside]]), np.concatenate([down_b, up_b[inside]])


class Alignment:
    """Groups of the tokens of two sides: cuts are the bytes at which both have a token's end."""

    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b = a, b
        self.pairs = overlaps(a, b)
        at, other = self.pairs
        equal = a.end[at] == b.end[other]
        self.last_a, self.last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
        self.last_a[at[equal]] = True
        self.last_b[other[equal]] = True
        self.group_a = np.cumsum(self.last_a) - self.last_a
        self.group_b = np.cumsum(self.last_b) - self.last_b
        self.doc = a.doc[self.last_a]
        n = len(self.doc)
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)

    def totals(self, docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of groups and of links of each text."""
        links = np.zeros(docs, np.int64)
        np.add.at(links, self.doc, self.size_a * self.size_b)
        return np.bincount(self.doc, minlength=docs), links

    def linked_ids(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, id pair, number of links) of all distinct pairs of linked ids, sorted by text and pair.

        Within a group equal ids are counted before they are multiplied out, so a long group costs its distinct ids.
        """
        one = (self.size_a == 1) & (self.size_b == 1)
        some_a, some_b = one[self.group_a], one[self.group_b]
        keys = self.a.ids[some_a] * PAIR + self.b.ids[some_b]
        parts = [_summed(self.a.doc[some_a], keys, np.ones(len(keys), np.int64))]
        group_a, id_a, times_a = _summed(self.group_a[~some_a], self.a.ids[~some_a], np.ones(int((~some_a).sum()), np.int64))
        group_b, id_b, times_b = _summed(self.group_b[~some_b], self.b.ids[~some_b], np.ones(int((~some_b).sum()), np.int64))
        first = np.searchsorted(group_b, group_a)
        width = np.searchsorted(group_b, group_a, "right") - first
        reach = np.cumsum(width)
        lo = 0
        while lo < len(width):
            hi = max(lo + 1, int(np.searchsorted(reach, reach[lo] - width[lo] + PAIRS_AT_ONCE, "right")))
            w = width[lo:hi]
            left = np.repeat(np.arange(lo, hi), w)
            right = np.repeat(first[lo:hi], w) + np.arange(len(left)) - np.repeat(np.cumsum(w) - w, w)
            parts.append(_summed(self.doc[group_a[left]], id_a[left] * PAIR + id_b[right], times_a[left] * times_b[right]))
            lo = hi
        return _summed(*map(np.concatenate, zip(*parts)))

    def written(self, names_a: list[str], names_b: list[str], docs: int) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each text, given each id with the mark that follows it inside a group and at its end."""
        order_a = np.arange(len(self.a.ids)) + np.append(0, np.cumsum(self.size_b))[self.group_a]
        order_b = np.arange(len(self.b.ids)) + np.cumsum(self.size_a)[self.group_b]
        codes = np.empty(len(order_a) + len(order_b), np.int64)
        codes[order_a] = 2 * self.a.ids + self.last_a
        codes[order_b] = len(names_a) + 2 * self.b.ids + self.last_b
        names, codes = (names_a + names_b).__getitem__, codes.tolist()
        ends = np.cumsum(self.a.counts + self.b.counts).tolist()
        return ["".join(map(names, codes[lo:hi]))[:-1] for lo, hi in zip([0, *ends], ends[:docs])]


def _summed(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (x, y), sorted, with the sums of ``times``."""
    if len(x) and int(x.max()) * (span := int(y.max()) + 1) < 2**62:
        order = np.argsort(x * span + y, kind="stable")
    else:
        order = np.lexsort((y, x))
    x, y, times = x[order], y[order], times[order]
    first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(x)])
    return x[first], y[first], np.add.reduceat(times, first) if len(first) else times


class Aligner:
    def __init__(self, first: bytes, by_rank: bool, second: bytes):
        self.sides = ByteLevel(first, by_rank), Pieces(second)
        self.lengths = [np.fromiter(map(len, s.bytes), np.int64, s.size) for s in self.sides]
        self.names = [[f"{i}{mark}" for i in range(s.size) for mark in marks] for s, marks in zip(self.sides, (",|", ",;"))]

    def aligned(self, texts: list[bytes | None]) -> Alignment:
        """Texts that are null, empty, not UTF-8 or whose tokens do not spell them have no tokens."""
        spaced = []
        for t in texts:
            try:
                spaced.append(" " + t.decode() if t else None)
            except UnicodeDecodeError:
                spaced.append(None)
        asked = [i for i, t in enumerate(spaced) if t is not None]
        ids = [s.encode([spaced[i] for i in asked]) for s in self.sides]
        found = [[[]] * len(texts), [[]] * len(texts)]
        for place, i in enumerate(asked):
            whole = b" " + texts[i]
            if all(b"".join(map(s.bytes.__getitem__, x[place])) == whole for s, x in zip(self.sides, ids)):
                found[0][i], found[1][i] = ids[0][place], ids[1][place]
        return Alignment(*[Tokens(x, lengths) for x, lengths in zip(found, self.lengths)])

    def runs(self, column: pa.Array) -> Iterator[tuple[int, Alignment, int]]:
        """(first row, alignment, rows) of runs of CHUNK_BYTES at most, or of one longer text."""
        sizes = np.fromiter((len(t) if t else 0 for t in column.to_pylist()), np.int64, len(column))
        lo = 0
        while lo < len(sizes):
            hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), CHUNK_BYTES, "right")))
            yield lo, self.aligned(column[lo:hi].to_pylist()), min(hi, len(sizes)) - lo
            lo = hi


def _shared(documents: DataFrame, first: str, second: str):
    with open(first, "rb") as a, open(second, "rb") as b:
        definition, model = a.read(), b.read()
    return documents.sparkSession.sparkContext.broadcast((definition, merges_by_rank(definition), model))


LINK = T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())])
DIGEST = [*[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")], T.StructField("groups_sha256", T.StringType())]
STORED = T.StructType([T.StructField("row", T.LongType()), *DIGEST, T.StructField("links", T.ArrayType(LINK))])


def token_overlaps(documents: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """doc_id and, in order, the overlapping tokens of both sides: a_pos, b_pos, a_id, b_id, a_end, b_end.

    Where a_end and b_end are equal, a group of the alignment ends.
    """
    shared = _shared(documents, first, second)
    names = ["a_pos", "b_pos", "a_id", "b_id", "a_end", "b_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for batch in batches:
            for lo, x, n in aligner.runs(batch["text"]):
                at, other = x.pairs
                order = np.lexsort((other, at))
                at, other = at[order], other[order]
                begin = [np.append(0, np.cumsum(s.counts))[s.doc[p]] for s, p in ((x.a, at), (x.b, other))]
                columns = [at - begin[0], other - begin[1], x.a.ids[at], x.b.ids[other], x.a.end[at], x.b.end[other]]
                doc_id = batch["doc_id"].slice(lo, n).take(pa.array(x.a.doc[at]))
                yield pa.RecordBatch.from_arrays([doc_id, *map(pa.array, columns)], ["doc_id", *names])

    rows = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names]])
    return rows.mapInArrow(run, schema)


def _stored(documents: DataFrame, first: str, second: str) -> DataFrame:
    """Each document's totals and its distinct pairs of linked ids, written once; long lists of pairs take several rows."""
    shared = _shared(documents, first, second)
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text"))
    schema = T.StructType([STORED["row"], rows.schema["doc_id"], *STORED.fields[1:]])
    arrow = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for batch in batches:
            for lo, x, n in aligner.runs(batch["text"]):
                groups, links = x.totals(n)
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in x.written(*aligner.names, n)]
                doc, pair, times = x.linked_ids()
                starts = np.searchsorted(doc, np.arange(n + 1))
                pieces = np.maximum(1, -(-np.diff(starts) // PAIRS_IN_ROW))
                which = np.repeat(np.arange(n), pieces)
                part = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                offsets = np.append(starts[which] + part * PAIRS_IN_ROW, len(doc))
                cells = pa.StructArray.from_arrays([pa.array(pair), pa.array(times)], ["pair", "times"])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells).cast(arrow)
                at = pa.array(which)
                # totals stand in the first row of a document only
                whole = [pa.array(v, mask=part > 0) for v in (x.a.counts[which], x.b.counts[which], groups[which], links[which])]
                whole.append(pa.array(np.array(digests, object)[which], pa.string(), mask=part > 0))
                ids = [batch[c].slice(lo, n).take(at) for c in ("row", "doc_id")]
                yield pa.RecordBatch.from_arrays([*ids, *whole, lists], schema.names)

    path = scratch_path(documents.sparkSession, "links")
    rows.mapInArrow(run, schema).write.parquet(path)
    return documents.sparkSession.read.schema(schema).parquet(path)


def pair_counts(links: DataFrame) -> DataFrame:
    """pair, n and best: how many documents hold two ids linked, and whether no other partner of the first id is in more.

    ``links`` holds each pair of a document once.
    """
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    partners = Window.partitionBy(F.shiftright("pair", 32))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(partners)).cast("long").alias("best"))


def alignments(documents: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of the alignment of every text.

    ``first`` is a byte-level definition and encodes a space and the text; ``second`` is a piece model that adds the space
    itself. Special strings inside texts are plain text. Groups are cut where tokens of both sides end at the same byte;
    links are all pairs of one token of each side in a group; a pair's count is the number of documents in which its ids
    are linked; best links have the highest count of their first id, ties included.

    Null and empty texts, texts that are not UTF-8, and texts that the tokens of a side do not spell, have no tokens:
    zeros and an empty digest. Repeated rows are documents of their own, whatever their id; null ids are kept. Long texts
    are aligned whole. Other columns are not read; an empty table gives no rows.

    A document's distinct pairs are stored, counted with map-side sums (so a pair in every document is no hot key) and
    looked up again: by broadcast while the measured table of pairs is small, otherwise by a join whose hot keys Spark splits.
    """
    tune(documents.sparkSession)
    stored = _stored(documents, first, second)
    links = stored.select("row", F.inline("links"))
    counted = join_small(links, pair_counts(links), "pair", max_rows=BROADCAST_PAIRS)
    sums = counted.groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    whole = stored.filter(F.col("n_a").isNotNull()).drop("links").join(sums, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


@query("op13_token_alignment")
def _op13(spark, sf_dir):
    return alignments(table(spark, sf_dir, "documents"))
