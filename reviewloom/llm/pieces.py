"""SentencePiece encoding and decoding with a streaming Viterbi search."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.registry import query, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
# kinds of pieces and models as the model file numbers them
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, PAIRS = 1, 2
REMEMBERED = 300_000
REMEMBERED_CHARS = 64
# texts that are cut, looked up and joined at once: so many rows, or fewer that hold so many bytes
ROWS_AT_ONCE, BYTES_AT_ONCE = 4096, 4_000_000
SIDE_BY_SIDE = 4096
SLOT_BITS, PAIR_BITS = 18, 21
# characters without a piece are numbered from here
UNKNOWN_ID = 1 << 24
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


class Slots:
    """Numbers >= 0 or -2 by 64-bit key, looked up for whole arrays at once; open addressing, at most half full."""

    def __init__(self, bits: int):
        self.shift, self.mask, self.n = np.uint64(64 - bits), (1 << bits) - 1, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)

    def full(self) -> bool:
        return 2 * self.n > self.mask

    def add(self, key: int, value: int) -> None:
        if self.full() or not key:
            raise ValueError("a larger table or another factor is needed")
        slot = (key * int(_SPREAD)) % (1 << 64) >> int(self.shift)
        while self.keys[slot] and self.keys[slot] != key:
            slot = (slot + 1) & self.mask
        self.n += not self.keys[slot]
        self.keys[slot], self.values[slot] = key, value

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slot = ((keys * _SPREAD) >> self.shift).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            here = self.keys[slot]
            hit = here == keys[rest]
            out[rest[hit]] = self.values[slot[hit]]
            on = ~hit & (here != 0)
            rest, slot = rest[on], (slot[on] + 1) & self.mask
        return out


def gathered(values: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values`` are runs of these sizes on end. The runs that the codes number, on end, and where each begins and the last ends."""
    counts = sizes[codes]
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    at = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], counts)
    at += np.arange(ends[-1])
    return values[at], ends


class PieceModel:
    """A loaded model: its pieces, and the segmentation of a span by a search that keeps a bounded window.

    A model of scored pieces (unigram) is segmented into the pieces of greatest total score; on equal totals the
    longer last piece wins. In a model of merged pairs the segmentation of a prefix is unique, and two neighbouring
    pieces can stand in one exactly if merging their joined text gives these two pieces back. So both searches keep,
    for every position, one backpointer: the length of the last piece of the path that survives there. A later piece
    starts at most the longest piece's length back, hence only the paths of so many last positions survive; where
    they meet in one boundary, all before it is committed and forgotten.
    """

    def __init__(self, definition: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(definition)
        norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or kind not in (UNIGRAM, PAIRS):
            raise ValueError("only models of scored pieces or merged pairs whose texts stay as they are")
        if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not covered")
        self.pairs = kind == PAIRS
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.longest = max(map(len, self.ids), default=1)
        self.penalty = min(self.scores.values(), default=0.0) - 10.0
        self.ends = {p[i:] for p in self.ids for i in range(len(p))}
        self._stands: dict[tuple[str, str], bool] = {}
        self.pairs_known = Slots(PAIR_BITS)
        self._fill_slots()
        # where no piece can reach across, every path has a boundary: before a space mark that follows other text,
        # and around control characters that no piece holds
        alphabet = set().union(*self.ids) if self.ids else set()
        alone = "".join(c for c in "\n\r\t" if c not in alphabet)
        inside = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        cut = (f"[{alone}]|" if alone else "") + (f"[^{alone}]+" if inside else f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")
        self.cut = re.compile(cut).findall
        self.alone, self.inside = alone, inside
        shown = [self._text_of(p) for p in proto.pieces]
        self.shown, self.shown_sizes = np.frombuffer(b"".join(shown), np.uint8), np.array([len(t) for t in shown])

    @staticmethod
    def _text_of(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:-1], 16)])
        if piece.type == CONTROL:
            return b""
        return " ⁇ ".encode() if piece.type == UNKNOWN else piece.piece.replace(SPACE, " ").encode()

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: the best pair first, the leftmost of equal ones."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stand(self, left: str, right: str) -> bool:
        """Can the two pieces stand side by side; ``left`` is empty at the start of a span."""
        if len(self._stands) > 2 * REMEMBERED:
            self._stands.clear()
        known = self._stands[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def _step_pairs(self, text: str, p: int, lens: list[int], before: str) -> int:
        # no piece ends in more of the text than these characters
        most, size = min(self.longest, p), 1
        while size < most and text[p - size - 1 : p] in self.ends:
            size += 1
        for size in range(size, 0, -1):
            piece = text[p - size : p]
            if size > 1 and piece not in self.ids:
                continue
            start = p - size
            left = text[start - lens[start] : start] if start else before
            known = self._stands.get((left, piece))
            if known or known is None and self._stand(left, piece):
                return size
        raise AssertionError("every prefix has a segmentation")

    def _step_scored(self, text: str, p: int, totals: list[float]) -> int:
        best, chosen = None, 1
        for size in range(min(self.longest, p), 0, -1):
            piece = text[p - size : p]
            score = self.scores.get(piece, self.penalty if size == 1 else None)
            if score is not None and (best is None or totals[p - size] + score > best):
                best, chosen = totals[p - size] + score, size
        totals.append(best)
        return chosen

    def stream(self, characters) -> Iterator[str]:
        """The pieces of a span read character by character, each as soon as no later text can change it."""
        text, lens, totals, before, p = "", [0], [0.0], "", 0
        for c in characters:
            text += c
            p += 1
            lens.append(self._step_pairs(text, p, lens, before) if self.pairs else self._step_scored(text, p, totals))
            if p >= 4 * self.longest:
                met = self._meet(lens, p)
                if met:
                    done = self._walk(text, lens, met)
                    yield from done
                    before = done[-1]
                    text, lens, p = text[met:], [0, *lens[met + 1 :]], p - met
                    totals = [t - totals[met] for t in totals[met:]]
        yield from self._walk(text, lens, p)

    def _meet(self, lens: list[int], p: int) -> int:
        """The boundary in which the paths of all live positions meet; 0 if only the start."""
        live = set(range(p + 1 - self.longest, p + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(last - lens[last])
        return live.pop()

    @staticmethod
    def _walk(text: str, lens: list[int], p: int) -> list[str]:
        out = []
        while p:
            out.append(text[p - lens[p] : p])
            p -= lens[p]
        return out[::-1]

    def ids_of(self, span: str) -> list[int]:
        out: list[int] = []
        for piece in self.stream(span):
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            else:
                self._add_unknown(out, piece)
        return out

    def _add_unknown(self, out: list[int], character: str) -> None:
        if self.bytes:
            out.extend(self.bytes[b] for b in character.encode())
        elif not out or out[-1] != self.unknown:
            out.append(self.unknown)

    def packed_many(self, spans: list[str]) -> list[bytes]:
        """``ids_of`` as int32 for many spans: short ones of merged pairs go through the same search side by side."""
        out = [b""] * len(spans)
        short = [i for i, s in enumerate(spans) if self.pairs and len(s) <= 2 * self.longest]
        for i in set(range(len(spans))).difference(short):
            out[i] = np.array(self.ids_of(spans[i]), np.int32).tobytes()
        short.sort(key=lambda i: len(spans[i]))
        for lo in range(0, len(short), SIDE_BY_SIDE):
            part = short[lo : lo + SIDE_BY_SIDE]
            for i, ids in zip(part, self._side_by_side([spans[i] for i in part])):
                out[i] = ids
        return out

    def _side_by_side(self, spans: list[str]) -> list[bytes]:
        """One backpointer for each position of each span, as ``stream`` finds them, column by column."""
        n, longest = len(spans), max(map(len, spans))
        sizes = np.array([len(s) for s in spans])
        # one row for each position, so that a step reads and writes neighbours
        codes = np.zeros((n, longest), np.uint64)
        codes[np.arange(longest) < sizes[:, None]] = np.frombuffer("".join(spans).encode("utf-32-le"), np.uint32)
        flat = codes.T.ravel()
        # pieces[k][p]: the piece of k + 1 characters that ends with character p, -1 if there is none; only places
        # where that many characters end some piece are looked at
        pieces, at = [], np.flatnonzero(flat)
        hashes, power = np.zeros(len(at), np.uint64), 1
        for k in range(min(self.longest, longest)):
            inside = np.searchsorted(at, k * n)
            at = at[inside:]
            hashes = hashes[inside:] + (flat[at - k * n] + np.uint64(1)) * np.uint64(power)
            power = power * int(_FACTOR) % (1 << 64)
            found = self.slots.find(hashes)
            here = np.full(n * longest, -1, np.int32)
            # a character without a piece stands for itself
            here[at] = np.where(found < 0, UNKNOWN_ID + flat[at].astype(np.int64), found) if k == 0 else found
            pieces.append(here.reshape(longest, n))
            alive = found != -1
            at, hashes = at[alive], hashes[alive]
        last = np.full((longest + 1, n), -1, np.int64)
        back = np.zeros((longest + 1, n), np.int32)
        for p in range(1, longest + 1):
            open_ = np.flatnonzero(sizes >= p)
            for k in range(min(self.longest, p) - 1, -1, -1):
                right = pieces[k][p - 1][open_]
                place = np.flatnonzero(right >= 0)
                if not len(place):
                    continue
                rows, right = open_[place], right[place]
                good = self._stand_many(last[p - k - 1][rows], right)
                last[p][rows[good]], back[p][rows[good]] = right[good], k + 1
                open_ = np.delete(open_, place[good])
        return self._walk_back(last, back, sizes)

    def _walk_back(self, last: np.ndarray, back: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        columns, rows, place = [], np.arange(len(sizes)), sizes.copy()
        while place.any():
            columns.append(np.where(place > 0, last[place, rows], -1))
            place -= back[place, rows]
        ids = np.stack(columns[::-1], 1)
        first = (ids < 0).sum(1).tolist()
        unknown = (ids >= UNKNOWN_ID).any(1).tolist()
        packed = ids.astype(np.int32)
        return [self._spelled(ids[i, a:].tolist()) if unknown[i] else packed[i, a:].tobytes() for i, a in enumerate(first)]

    def _spelled(self, found: list[int]) -> bytes:
        out: list[int] = []
        for i in found:
            if i < UNKNOWN_ID:
                out.append(i)
            else:
                self._add_unknown(out, chr(i - UNKNOWN_ID))
        return np.array(out, np.int32).tobytes()

    def _fill_slots(self) -> None:
        self.names = {i: p for p, i in self.ids.items()}
        self.slots, seen = Slots(SLOT_BITS), set()
        for end in self.ends:
            h, power = 0, 1
            for c in reversed(end):
                h, power = (h + (ord(c) + 1) * power) % (1 << 64), power * int(_FACTOR) % (1 << 64)
            if h in seen:
                raise ValueError("two pieces share a hash; choose another factor")
            seen.add(h)
            # ends of pieces that are none themselves get -2
            self.slots.add(h, self.ids.get(end, -2))

    def _name(self, i: int) -> str:
        return "" if i < 0 else self.names[i] if i < UNKNOWN_ID else chr(i - UNKNOWN_ID)

    def _stand_many(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = ((left + 1) << 32 | right).astype(np.uint64)
        good = self.pairs_known.find(keys)
        new = np.unique(keys[good == -1])
        if len(new):
            for k in new.tolist():
                if self.pairs_known.full():
                    self.pairs_known = Slots(PAIR_BITS)
                stands = self._stand(self._name((k >> 32) - 1), self._name(k & 0xFFFFFFFF))
                self.pairs_known.add(k, int(stands))
            # a table that was emptied on the way lacks the earlier ones
            return self._stand_many(left, right)
        return good == 1

    def spans(self, text: str) -> list[str]:
        return self.cut(self.prefix + text.replace(" ", SPACE)) if text else []

    def cut_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The spans of many texts, as ``spans`` finds them, with plain spaces for space marks: the UTF-8 bytes of all on
        end, where each span begins (and the last ends), and the number of the first span of each text (and of all)."""
        plain, lead = pc.replace_substring(texts.cast(pa.string()).fill_null(""), SPACE, " "), self.prefix.replace(SPACE, " ")
        if lead:
            plain = pc.if_else(pc.equal(plain, ""), "", pc.binary_join_element_wise(lead, plain, ""))
        _, offsets, data = plain.buffers()
        bounds = np.frombuffer(offsets, np.int32)[plain.offset : plain.offset + len(plain) + 1]
        data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        begins = np.zeros(len(data) + 1, bool)
        if not self.inside:
            space = data == ord(" ")
            begins[1:-1] = space[1:] & ~space[:-1]
        for c in self.alone:
            at = np.flatnonzero(data == ord(c))
            begins[at] = begins[at + 1] = True
        begins[bounds] = True
        starts = np.flatnonzero(begins)
        return data, starts, np.searchsorted(starts, bounds)

    def decode(self, ids: list[int]) -> str:
        return self.decode_many(np.array(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each list of ids; the lists lie on end."""
        shown, ends = gathered(self.shown, self.shown_sizes, ids)
        shown, bounds = shown.tobytes(), ends[offsets].tolist()
        texts = [shown[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
        # the space of the prefix goes, that of an unknown piece stays
        led = np.append(ids, self.unknown)[offsets[:-1]] != self.unknown
        return [t[1:] if strip and t[:1] == " " else t for t, strip in zip(texts, led.tolist())] if self.prefix else texts


class Encoder(dict):
    """Span -> its ids as packed int32. Short spans are remembered in two halves: when the new half is full it becomes
    the old one, and what is used again moves over, so frequent spans stay while memory is bounded."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model, self.old = model, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, offsets = self.ids(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts on end, and where those of each text begin and the last end. Each distinct span is looked up
        once, however often the texts repeat it; a null text has no ids."""
        data, starts, first = self.model.cut_many(texts)
        spans = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        packed = self._packed(spans.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        ids, ends = gathered(np.frombuffer(b"".join(packed), np.int32), sizes, spans.indices.to_numpy())
        return ids, ends[first]

    def _packed(self, spans: list[str]) -> list[bytes]:
        out = list(map(self.get, spans))
        missing = [i for i, ids in enumerate(out) if ids is None]
        for i in missing:
            out[i] = self.old.get(spans[i])
        rest = [i for i in missing if out[i] is None]
        for i, ids in zip(rest, self.model.packed_many([spans[i].replace(" ", SPACE) for i in rest])):
            out[i] = ids
        self.update((spans[i], out[i]) for i in missing)
        if len(self) >= REMEMBERED:
            self.old = {s: ids for s, ids in self.items() if len(s) <= REMEMBERED_CHARS}
            self.clear()
        return out


@lru_cache(maxsize=1)
def _loaded(definition: bytes) -> PieceModel:
    """The model, made once for the tasks that follow one another in a worker."""
    return PieceModel(definition)


def _definition(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of bounded rows and bytes; a text beyond the bound is a piece by itself."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
    lo, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > lo and (i - lo >= ROWS_AT_ONCE or size + n > BYTES_AT_ONCE):
            yield batch.slice(lo, i - lo)
            lo, size = i, 0
        size += n
    yield batch.slice(lo)


def _place(rows: DataFrame, name: str) -> int:
    return [c.lower() for c in rows.columns].index(name.lower())


def _with_columns(rows: DataFrame, added: list[T.StructField], run: Callable) -> DataFrame:
    """The rows with added columns, in place of those of the same name. ``run`` turns batches into pairs of the batch and
    the arrays to add."""
    names = {f.name.lower() for f in added}
    kept = [i for i, c in enumerate(rows.columns) if c.lower() not in names]
    schema = T.StructType([*(rows.schema.fields[i] for i in kept), *added])
    titles = [f.name for f in schema]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, new in run(batches):
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *new], titles)

    return rows.mapInArrow(step, schema)


def encode(documents: DataFrame, text: str = "text", out: str = "ids", model: str = MODEL, decoded: str | None = None) -> DataFrame:
    """Add the piece ids of every text, as the model's own library gives them for a model of merged pairs.

    No begin or end ids. Null texts give null, empty texts no ids. Spans that every path must cut are searched alone;
    a span without such cuts is streamed through a window (see PieceModel). An input column named ``out`` is
    replaced. Rows are independent: no shuffle, repeated rows give repeated results, empty tables stay empty. The
    model file is broadcast; it is bounded by its vocabulary. With ``decoded`` a further column of that name holds the
    text that the ids give back, as ``decode`` would, found in the same pass.
    """
    shared = documents.sparkSession.sparkContext.broadcast(_definition(model))
    source = _place(documents, text)
    added = [T.StructField(out, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.StringType())] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(_loaded(shared.value))
        for batch in batches:
            for part in _slices(batch, source):
                texts = part.column(source)
                ids, offsets = encoder.ids(texts)
                absent = texts.is_null().to_numpy(zero_copy_only=False)
                places = pa.array(offsets.astype(np.int32), pa.int32(), mask=np.append(absent, False))
                new = [pa.ListArray.from_arrays(places, pa.array(ids))]
                if decoded:
                    new.append(pa.array(encoder.model.decode_many(ids, offsets), pa.string(), mask=absent))
                yield part, new

    return _with_columns(documents, added, run)


def decode(rows: DataFrame, ids: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """Add the text of piece ids; null ids give null, a null among the ids reads as the unknown piece. An input column
    named ``out``, be it that of the ids, is replaced.

    Decoding undoes encoding but for texts that hold the space mark U+2581 itself, which come back with a space.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_definition(model))
    source = _place(rows, ids)

    def run(batches: Iterator[pa.RecordBatch]):
        model_ = _loaded(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                lists = part.column(source)
                sizes = pc.list_value_length(lists).fill_null(0).to_numpy()
                offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
                texts = model_.decode_many(lists.flatten().fill_null(model_.unknown).to_numpy(), offsets)
                yield part, [pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))]

    return _with_columns(rows, [T.StructField(out, T.StringType())], run)


def encoded(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, their number, and whether decoding gives the text back."""
    back = encode(documents.select("doc_id", "text"), model=model, decoded="decoded")
    return back.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("op2_streaming_pieces")
def _op2(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"))
