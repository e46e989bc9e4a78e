"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes through a text's characters and keeps, for each place in a window of the
longest piece's length, the best way to get there and a pointer back. Whenever the pointers
of all places that a later piece may still start from lead through one boundary, the ids up
to it are final: they are handed out and forgotten. So what is held is the window and what
is undecided, however long the text.

Both kinds of model are searched so. For a unigram model the best way is that of the
highest sum of scores. For a BPE model a segmentation is the one that merging gives exactly
if each two neighbouring pieces, merged by themselves, stay those two pieces; so a piece may
follow another only then, one way leads to each place, and the ids are the library's.

No piece goes on after a blank that follows something else, nor across two characters that
stand side by side in no piece, so all ways meet there. Units between such places repeat,
and each distinct unit is searched once; units of a batch are cut and looked up by array
operations.

Defined cases: a NULL text is empty, an empty text has no ids; characters without a piece
give their bytes' ids where the model has them, else the unknown id; decoding of bytes that
are no character gives U+FFFD; a text of any length is encoded whole; repeated rows are
encoded alike; an empty table gives an empty result. Input columns called like the added
ones are replaced. Models with user-defined pieces are refused.
"""

from __future__ import annotations

import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import freed, slices, text_of, unused, with_field
from .wordhash import buffer_of, hashes

BLANK = "▁"
UNIGRAM, BPE = 1, 2
CACHE_UNITS, CACHE_PAIRS = 300_000, 500_000
STEP_ROWS = 500  # texts whose characters and ids a step holds in arrays
UNKNOWN_PENALTY = 10.0


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, raw[at:at + size]
            at += size


def model_type(raw: bytes) -> int:
    """The kind of a model file: trainer_spec is field 2, its model_type field 3."""
    trainer = dict(_fields(raw)).get(2, b"")
    return dict(_fields(trainer)).get(3, UNIGRAM)


class Pieces:
    """What the search needs of a model."""

    def __init__(self, pieces: dict[str, int], scores: dict[str, float], kind: int,
                 byte_ids: list[int] | None, unknown: int):
        self.ids, self.scores, self.kind = pieces, scores, kind
        self.byte_ids, self.unknown = byte_ids, unknown
        self.longest = max(map(len, pieces), default=1)
        # every ending of a piece, with the piece's score if it is one itself
        self.endings: dict[str, float | None] = {n[i:]: None for n in pieces for i in range(1, len(n))}
        self.endings.update(scores)
        self.floor = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.follows: dict[int, bool] = {}  # by the ids of both pieces, as one number

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives: always the best-scored neighbours, the leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, left: str, right: str) -> bool:
        # a character without a piece takes part in no merge, nor does a piece beside it
        ids = self.ids
        if not left or left not in ids or right not in ids:
            return self.merged(left + right) == ([left, right] if left else [right])
        key = ids[left] << 32 | ids[right]
        found = self.follows.get(key)
        if found is None:
            if len(self.follows) >= CACHE_PAIRS:
                self.follows.clear()
            found = self.follows[key] = self.merged(left + right) == [left, right]
        return found

    def ids_of(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        if self.byte_ids is None:
            return [self.unknown]
        return [self.byte_ids[b] for b in piece.encode()]


class Search:
    """A search in progress: ``push`` characters, collect final pieces, ``finish``."""

    def __init__(self, model: Pieces):
        self.model, self.base, self.text = model, 0, ""
        # per place from ``base`` on: (score, start of the piece that ends there, that piece)
        self.best: list[tuple[float, int, str]] = [(0.0, 0, "")]
        self.most_held = 0

    def push(self, chars: str) -> list[str]:
        out = []
        for c in chars:
            self.text += c
            self._extend()
            if len(self.text) >= 2 * self.model.longest and len(self.text) % self.model.longest == 0:
                out += self._commit(self.model.longest)
        self.most_held = max(self.most_held, len(self.text))
        return out

    def finish(self) -> list[str]:
        return self._commit(0)

    def _extend(self) -> None:
        model, text, end, best = self.model, self.text, len(self.text), self.best
        endings, merging, top = model.endings, model.kind == BPE, None
        for start in range(end - 1, max(-1, end - model.longest - 1), -1):
            piece = text[start:end]
            score = endings.get(piece, self)
            if score is self or score is None:
                if end - start == 1 and piece not in model.scores:
                    known = score is None  # a character without a piece of its own
                    score = model.floor
                elif score is self:
                    break
                else:
                    continue
            else:
                known = True
            before = best[start]
            if before is None:
                pass
            elif merging:
                if model.may_follow(before[2], piece):
                    top = (0.0, start, piece)
                    break
            elif top is None or before[0] + score >= top[0]:
                top = (before[0] + score, start, piece)
            if not known:
                break
        best.append(top)

    def rewind(self, size: int) -> None:
        """Forget the characters after the first ``size``; only before anything is final."""
        self.text = self.text[:size]
        del self.best[size + 1:]

    def path(self) -> list[str]:
        """The pieces of all characters that are held."""
        out, at = [], len(self.text)
        while at:
            _, start, piece = self.best[at]
            out.append(piece)
            at = start
        return out[::-1]

    def _commit(self, window: int) -> list[str]:
        """The pieces up to the last boundary that all ways into the window share."""
        ways = {len(self.text)} if not window else {
            i for i in range(len(self.text) - window + 1, len(self.text) + 1) if self.best[i] is not None}
        while len(ways) > 1:
            last = max(ways)
            ways.remove(last)
            ways.add(self.best[last][1])
        boundary = ways.pop()
        if not boundary:
            return []
        rest, self.text = self.text, self.text[:boundary]
        out, self.text = self.path(), rest
        score = self.best[boundary][0]
        last = (0.0, 0, self.best[boundary][2])
        self.text = self.text[boundary:]
        self.best = [last] + [b if b is None else (b[0] - score, b[1] - boundary, b[2])
                              for b in self.best[boundary + 1:]]
        return out


class Coder:
    """Encodes batches; keeps about ``CACHE_UNITS`` units between calls."""

    def __init__(self, path: str):
        import sentencepiece

        self.path = path
        with open(path, "rb") as f:
            raw = f.read()
        tool = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.normalize = tool.normalize
        size = tool.get_piece_size()
        names = [tool.id_to_piece(i) for i in range(size)]
        special = [tool.is_control(i) or tool.is_unknown(i) or tool.is_byte(i) or tool.is_unused(i)
                   for i in range(size)]
        if any(dict(_fields(v)).get(3) == 4 for n, v in _fields(raw) if n == 1):
            raise ValueError("the model has user-defined pieces")
        byte_ids = [i for i in range(size) if tool.is_byte(i)]
        pieces = {n: i for i, n in enumerate(names) if not special[i]}
        self.model = Pieces(pieces, {n: tool.get_score(i) for n, i in pieces.items()}, model_type(raw),
                            sorted(byte_ids, key=lambda i: int(names[i][3:5], 16)) if byte_ids else None,
                            tool.unk_id())
        # ASCII neighbours that no piece holds side by side: all ways meet between them
        self.parted = np.zeros((256, 256), bool)
        self.parted[:128, :128] = True
        for n in pieces:
            for a, b in zip(n, n[1:]):
                if a < "\x80" and b < "\x80":
                    self.parted[ord(a), ord(b)] = False
        self.whole = not any(BLANK in n.lstrip(BLANK) for n in pieces)
        self._clear()

    def _clear(self) -> None:
        self.place: dict[int, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def unit_pieces(self, units: list[str]) -> list[list[str]]:
        """The pieces of each unit. Short units are searched in sorted order, each going on
        from what it shares with the one before; only long ones need their ids early."""
        out, shared = [[] for _ in units], Search(self.model)
        for i in sorted(range(len(units)), key=units.__getitem__):
            unit = units[i]
            if len(unit) >= 2 * self.model.longest:
                search = Search(self.model)
                out[i] = search.push(unit) + search.finish()
                continue
            same, most = 0, min(len(unit), len(shared.text))
            while same < most and unit[same] == shared.text[same]:
                same += 1
            shared.rewind(same)
            shared.push(unit[same:])
            out[i] = shared.path()
        return out

    def _learn(self, keys: list[int], units: list[bytes]) -> None:
        gc.disable()
        ids_of = self.model.ids_of
        found = [[i for piece in pieces for i in ids_of(piece)]
                 for pieces in self.unit_pieces([u.decode() for u in units])]
        gc.enable()
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        for key in keys:
            self.place[key] = len(self.place)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, np.array([i for ids in found for i in ids], np.uint32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in one uint32 array, ids per text)."""
        if len(self.place) > CACHE_UNITS:
            self._clear()
        data, at = buffer_of(pa.array([self.normalize(t or "") for t in texts.to_pylist()], pa.large_string()))
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        if self.whole:
            blank = np.zeros(len(data) + 3, bool)
            blank[3:] = (data == 0xE2) & (np.append(data[1:], 0) == 0x96) & (np.append(data[2:], [0, 0]) == 0x81)
            cut[:-1] |= blank[3:] & ~blank[:-3]
        cut[1:-1] |= self.parted[data[:-1], data[1:]]
        begin = np.flatnonzero(cut[:-1])
        end = np.append(begin[1:], len(data))
        keys, example, unit = np.unique(hashes(data, begin, end), return_index=True, return_inverse=True)
        get = self.place.get
        place = np.array([get(k, -1) for k in keys.tolist()], np.int64)
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            raw = data.tobytes()
            place[fresh] = len(self.place) + np.arange(len(fresh))
            spans = zip(begin[example[fresh]].tolist(), end[example[fresh]].tolist())
            self._learn(keys[fresh].tolist(), [raw[b:e] for b, e in spans])
        place = place[unit]
        lengths = self.lengths[place]
        stop = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[place] - (stop - lengths), lengths) + np.arange(stop[-1])]
        total = np.concatenate([[0], stop])
        return ids, np.diff(total[np.searchsorted(begin, at)])

    def decode(self, ids: list[int]) -> str:
        return decoder(self.path).decode(pa.array([ids], pa.list_(pa.int32())))[0]


class Decoder:
    """Texts of ids: the bytes of all pieces in one array, looked up by array operations."""

    def __init__(self, path: str):
        import sentencepiece

        tool = sentencepiece.SentencePieceProcessor(model_file=path)
        names = map(tool.id_to_piece, range(tool.get_piece_size()))
        raw = [b"" if tool.is_control(i) else bytes([int(n[3:5], 16)]) if tool.is_byte(i)
               else " ⁇ ".encode() if tool.is_unknown(i) else n.replace(BLANK, " ").encode()
               for i, n in enumerate(names)]
        self.lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.dummy = tool.normalize("a") == BLANK + "a"

    def decode(self, lists: pa.Array) -> list[str]:
        """The text of each list of ids; a NULL list is an empty text."""
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        ids = lists.flatten().to_numpy()
        lengths = self.lengths[ids]
        stop = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[ids] - stop[:-1], lengths) + np.arange(stop[-1])
        raw = self.bytes[at].tobytes()
        bounds = stop[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        texts = (raw[b:e].decode(errors="replace") for b, e in zip(bounds, bounds[1:]))
        return [t[1:] if self.dummy and t.startswith(" ") else t for t in texts]


@functools.lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder a Python worker."""
    return Coder(path)


@functools.lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encoded(df: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with its texts' ids as an array column."""
    names = [c for c in df.columns if c.lower() != ids_col.lower()]
    (text,) = unused(df, "_text")

    def encode(batches):
        tool = coder(model)
        for batch in slices(batches, STEP_ROWS):
            ids, lengths = tool.encode(batch.column(text))
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.ListArray.from_arrays(offsets, ids.view(np.int32))],
                [*names, ids_col])

    rows = df.select(*[f"`{c}`" for c in names], text_of(text_col).alias(text))
    schema = with_field(df.select(*[f"`{c}`" for c in names]).schema, ids_col, "array<int>")
    return rows.mapInArrow(freed(encode), schema)


def decoded(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the texts of its id arrays; a NULL array is an empty text."""
    names = [c for c in df.columns if c.lower() != text_col.lower()]

    def decode(batches):
        tool = decoder(model)
        for batch in slices(batches, STEP_ROWS):
            texts = pa.array(tool.decode(batch.column(ids_col)), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), texts], [*names, text_col])

    rows = df.select(*[f"`{c}`" for c in names])
    return rows.mapInArrow(freed(decode), with_field(rows.schema, text_col, "string"))
