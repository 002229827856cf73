"""SentencePiece BPE encoding with byte offsets, and decoding.

Texts are normalised by longest-prefix matches in the model's compiled
character map while the source position of every normalised byte is
recorded; the pieces found in the normalised text are then projected back
to spans of the original bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import PairTable, merge_words
from .shared import SLICE_BYTES, column, id_and_text, ship_package, text_slices

# Fixed values of the model format.
SPACE = "▁"
SPACE_BYTES = SPACE.encode()
BAD_BYTE = "�".encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE_MODEL = 2
UNSEEN = -1
# A place where a long text may be cut.
CUT = re.compile(f"(?<=[^ {SPACE}])[ {SPACE}]")
# Distinct chunks a worker remembers before it starts afresh.
REMEMBERED = 250_000
# Characters of a long text encoded, and ids decoded, at a time.
PIECE = SLICE_BYTES


class CharacterMap:
    """The compiled character map: a double-array trie of UTF-8 keys whose
    values point at NUL-terminated replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.replacements = blob[4 + size:]

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key that ``data`` has at
        ``at``; None if no key starts there."""
        node, found = self._jump(self.units[0]), None
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._jump(unit)
            if unit & 0x100:
                found = self.units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start = found[0]
        return self.replacements[start:self.replacements.index(b"\0", start)], found[1]


def _char_length(first: int) -> int:
    return 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


@dataclass(frozen=True)
class PieceModel:
    """A SentencePiece BPE model with byte fallback, read from its file."""
    path: str

    @cached_property
    def proto(self):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(self.path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if (model.trainer_spec.model_type != BPE_MODEL or not model.trainer_spec.byte_fallback
                or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or model.trainer_spec.treat_whitespace_as_suffix
                or not model.normalizer_spec.escape_whitespaces):
            raise ValueError(f"{self.path}: only BPE models with byte fallback, without user-defined pieces")
        return model

    @cached_property
    def character_map(self) -> CharacterMap | None:
        blob = self.proto.normalizer_spec.precompiled_charsmap
        return CharacterMap(blob) if blob else None

    @cached_property
    def pieces(self) -> dict[str, int]:
        return {p.piece: i for i, p in enumerate(self.proto.pieces) if p.type == NORMAL}

    @cached_property
    def byte_ids(self) -> np.ndarray:
        ids = np.full(256, -1, np.int32)
        for i, p in enumerate(self.proto.pieces):
            if p.type == BYTE:
                ids[int(p.piece[3:5], 16)] = i
        return ids

    @cached_property
    def symbols(self) -> tuple[np.ndarray, dict[str, int]]:
        """Symbol of every code point (UNSEEN if in no piece), and of every
        piece; letters that are no piece of their own come after them."""
        known = dict(self.pieces)
        for piece in self.pieces:
            for c in piece:
                known.setdefault(c, len(self.proto.pieces) + len(known))
        table = np.full(0x110000, UNSEEN, np.int32)
        for s, i in known.items():
            if len(s) == 1:
                table[ord(s)] = i
        return table, known

    @cached_property
    def pairs(self) -> PairTable:
        _, known = self.symbols
        score = {p: self.proto.pieces[i].score for p, i in self.pieces.items()}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        rows = [(known[p[:k]], known[p[k:]], rank[score[p]], i) for p, i in self.pieces.items()
                for k in range(1, len(p)) if p[:k] in known and p[k:] in known]
        return PairTable(*(zip(*rows) if rows else ((), (), (), ())))

    @cached_property
    def chunks(self) -> re.Pattern:
        """Pieces never hold a space mark after another character, nor a line
        break that is in no longer piece: merges cannot cross there."""
        inner = {c for p in self.pieces if len(p) > 1 for c in p}
        if self.space_inside:
            return re.compile(r"(?s).+")
        alone = "".join(c for c in "\n\r\t" if c not in inner)
        return re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+|(?s:.)")

    @cached_property
    def space_inside(self) -> bool:
        return any(SPACE in p.lstrip(SPACE) for p in self.pieces)


def normalise(model: PieceModel, text: bytes) -> tuple[bytes, np.ndarray]:
    """The normalised text and the source byte of each of its bytes, with one
    more entry for its end."""
    spec = model.proto.normalizer_spec
    trim = spec.remove_extra_whitespaces
    out, source, at = bytearray(), [], 0

    def step(at: int) -> tuple[bytes, int]:
        hit = model.character_map.longest(text, at) if model.character_map else None
        if hit:
            return hit
        size = _char_length(text[at])
        return text[at:at + size], size

    while trim and at < len(text):
        piece, size = step(at)
        if piece != b" ":
            break
        at += size
    if at == len(text):
        return b"", np.zeros(1, np.int64) + at
    if spec.add_dummy_prefix:
        out += SPACE_BYTES
        source += [at] * len(SPACE_BYTES)
    after_space = trim
    while at < len(text):
        piece, size = step(at)
        while after_space and piece.startswith(b" "):
            piece = piece[1:]
        if piece:
            escaped = piece.replace(b" ", SPACE_BYTES)
            out += escaped
            source += [at] * len(escaped)
            after_space = trim and piece.endswith(b" ")
        at += size
    end = len(text)
    while trim and out.endswith(SPACE_BYTES):
        end = source[len(out) - len(SPACE_BYTES)]
        del out[-len(SPACE_BYTES):]
        del source[len(out):]
    return bytes(out), np.asarray([*source, end], np.int64)


def _normalise_plain(texts: list[str], prefix: bool) -> tuple[list[str], np.ndarray]:
    """``normalise`` for a model without map and trimming, for many texts at
    once: the entries of all texts in order."""
    head = SPACE if prefix else ""
    normal = [head + t.replace(" ", SPACE) if t else "" for t in texts]
    raw = [t.encode("utf-8") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes)])
    # Per text: an entry for the prefix, the bytes, an entry for the end.
    text_of = np.repeat(np.arange(len(raw)), sizes + 2)
    place = np.arange(len(text_of)) - np.repeat(first[:-1] + 2 * np.arange(len(raw)), sizes + 2) - 1
    inside = (place >= 0) & (place < sizes[text_of])
    times = np.ones(len(place), np.int64)
    times[inside] = np.where(data == 0x20, len(SPACE_BYTES), 1)
    times[place < 0] = np.where((sizes > 0) & prefix, len(SPACE_BYTES), 0)
    return normal, np.repeat(np.maximum(place, 0), times)


class Codec:
    """Encodes and decodes texts; remembers chunks between batches."""

    def __init__(self, model: PieceModel):
        self.model = model
        spec = model.proto.normalizer_spec
        self.plain = model.character_map is None and not spec.remove_extra_whitespaces
        self._forget()
        self.sizes = np.array([len(p.piece.encode()) if p.type == NORMAL else 1 for p in model.proto.pieces], np.int64)
        self.shown = [p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else
                      bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else
                      model.proto.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else b""
                      for p in model.proto.pieces]
        self.is_byte = np.array([p.type == BYTE for p in model.proto.pieces])
        self.unknown = {i for i, p in enumerate(model.proto.pieces) if p.type == UNKNOWN}
        self.control = {i for i, p in enumerate(model.proto.pieces) if p.type == CONTROL}

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks and add them to the remembered ones."""
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        starts = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int64)
        ids, begins, starts = merge_words(self.model.symbols[0][points], starts, self.model.pairs)
        loose = (ids < 0) | (ids >= len(self.model.proto.pieces))
        if loose.any():
            # Characters outside the vocabulary fall back to their bytes.
            raw = {int(i): chr(points[begins[i]]).encode("utf-8") for i in np.flatnonzero(loose)}
            times = np.ones(len(ids), np.int64)
            times[list(raw)] = [len(b) for b in raw.values()]
            places = np.concatenate([[0], np.cumsum(times)])
            wide = np.repeat(ids, times)
            for i, b in raw.items():
                wide[places[i]:places[i + 1]] = self.model.byte_ids[list(b)]
            ids, starts = wide, places[starts]
        first = len(self.known)
        self.known.update(zip(chunks, range(first, first + len(chunks))))
        self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str], head: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the texts' starts among them, and the begin and
        end byte of every id's span in its original text.  Without ``head``
        the texts are later pieces of a text, which get no prefix."""
        if self.plain:
            normal, source = _normalise_plain(texts, head and self.model.proto.normalizer_spec.add_dummy_prefix)
        else:
            both = [normalise(self.model, t.encode("utf-8")) for t in texts]
            normal = [b.decode("utf-8") for b, _ in both]
            source = np.concatenate([s for _, s in both]) if both else np.zeros(0, np.int64)
        words: list[str] = []
        counts = []
        for text in normal:
            found = self.model.chunks.findall(text)
            words += found
            counts.append(len(found))
        distinct = set(words)
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        if rest := list(distinct - self.known.keys()):
            self._learn(rest)
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        lengths = self.starts[index + 1] - self.starts[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[index] - ends + lengths, lengths) + np.arange(total)]
        text_ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        starts = np.concatenate([[0], ends])[text_ends]
        # Normalised bytes run through all texts; each text has one entry more.
        piece_ends = np.cumsum(self.sizes[ids])
        shift = np.repeat(np.arange(len(texts)), np.diff(starts))
        return ids, starts, source[piece_ends - self.sizes[ids] + shift], source[piece_ends + shift]

    def pieces_of(self, text: str) -> Iterator[str]:
        """``text`` cut where no chunk crosses, before a space mark that
        follows another character, into pieces of ``PIECE`` characters or as
        many more as it takes to such a place.  A text that is normalised
        through a character map stays whole: what the map matches, and what
        is trimmed, may lie on both sides of a cut."""
        at = 0
        while self.plain and not self.model.space_inside and len(text) - at > PIECE:
            cut = CUT.search(text, at + PIECE)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def encode_long(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` of one text, a piece of it at a time."""
        parts, at = [], 0
        for piece in self.pieces_of(text):
            ids, _, begins, ends = self.encode([piece], head=at == 0)
            parts.append((ids, (begins + at).astype(np.int32), (ends + at).astype(np.int32)))
            at += len(piece.encode("utf-8"))
        ids, begins, ends = (np.concatenate(x) for x in zip(*parts))
        return ids, np.array([0, len(ids)]), begins, ends

    def decode_long(self, ids: np.ndarray) -> str:
        """``decode`` of the ids of one text, ``PIECE`` at a time; a run of
        byte pieces is not cut."""
        if len(ids) <= PIECE or np.isin(ids, list(self.control)).any():
            return self.decode(ids.tolist())
        parts, at = [], 0
        while len(ids) - at > PIECE:
            whole = np.flatnonzero(~self.is_byte[ids[at + PIECE:]])
            if not len(whole):
                break
            end = at + PIECE + int(whole[0])
            parts.append(self.decode(ids[at:end].tolist(), head=at == 0))
            at = end
        return "".join([*parts, self.decode(ids[at:].tolist(), head=at == 0)])

    def decode(self, ids: list[int], head: bool = True) -> str:
        """The text of a list of ids, as the library's decode gives it; without
        ``head`` the ids follow others and keep their leading space."""
        spec = self.model.proto.normalizer_spec
        parts = [self.shown[i] for i in ids]
        broken = not self.control.isdisjoint(ids)  # a control id ends a run of byte pieces
        first = next((k for k, i in enumerate(ids) if i not in self.control), len(ids))
        if head and (spec.add_dummy_prefix or spec.remove_extra_whitespaces):
            # The leading space is the prefix; where white space is trimmed
            # all leading space goes.  The mark of an unknown piece keeps its own.
            while first < len(ids) and not self.is_byte[ids[first]]:
                lead = parts[first].startswith(b" ") and ids[first] not in self.unknown
                parts[first] = parts[first][1:] if lead else parts[first]
                if parts[first] or not spec.remove_extra_whitespaces:
                    break
                first += 1
        if not broken:
            try:
                return b"".join(parts).decode("utf-8")
            except UnicodeDecodeError:
                pass
        return "".join(self._runs(ids, parts))

    def _runs(self, ids: list[int], parts: list[bytes]):
        """Runs of byte pieces that are no UTF-8: one mark per bad byte."""
        run = b""
        for i, part in zip([*ids, None], [*parts, b""]):
            if i is not None and self.is_byte[i]:
                run += part
                continue
            while run:
                size = _char_length(run[0])
                try:
                    yield run[:size].decode("utf-8")
                    run = run[size:]
                except UnicodeDecodeError:
                    yield BAD_BYTE.decode()
                    run = run[1:]
            yield part.decode("utf-8")


@lru_cache(maxsize=1)
def worker_codec(path: str) -> Codec:
    """One per worker process, kept from task to task."""
    return Codec(PieceModel(path))


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """Per row: ``id, n_bytes, ids, begins, ends`` and, if asked for,
    ``decoded``: the ids of the whole text without begin and end ids, the
    span of every piece in the text's UTF-8 bytes, and the text the ids
    decode to.

    Pieces of one character that fell back to bytes share its span's start:
    the first byte piece begins it and each covers its own byte.  Null texts
    count as empty, an empty text has no ids.  Null ids, ties and repeated
    rows come back as given; other columns are ignored; an empty table gives
    an empty result.  No shuffle; a task holds one slice of a megabyte, and of
    a longer text its lists and one piece of a megabyte in work (more where a
    stretch without spaces is longer).
    """
    ship_package(docs.sparkSession)

    def work(batches):
        codec = worker_codec(model_file)
        for batch in text_slices(batches):
            texts = column(batch, "text").to_pylist()
            long = len(texts) == 1 and len(texts[0]) > PIECE
            ids, starts, begins, ends = codec.encode_long(texts[0]) if long else codec.encode(texts)
            columns = {"id": column(batch, "id"), "n_bytes": pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                       "ids": _lists(ids, starts), "begins": _lists(begins, starts), "ends": _lists(ends, starts)}
            if decoded:
                bounds = zip(starts[:-1].tolist(), starts[1:].tolist())
                columns["decoded"] = pa.array([codec.decode_long(ids[a:b]) for a, b in bounds], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    rows = id_and_text(docs, id_col, text_col)
    schema = [f"id {rows.schema['id'].dataType.simpleString()}", "n_bytes long", "ids array<int>", "begins array<int>", "ends array<int>"]
    return rows.mapInArrow(work, ", ".join(schema + (["decoded string"] if decoded else [])))


def decode(encoded: DataFrame, model_file: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """Per row: ``id, decoded``.  A null list decodes to the empty text."""
    from pyspark.sql import functions as F
    ship_package(encoded.sparkSession)

    def work(batches):
        codec = worker_codec(model_file)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(texts, pa.string())], names=["id", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, decoded string")
