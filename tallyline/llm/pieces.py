"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

Pieces come from a public ``.model`` file. A unigram file's scores are log probabilities and are used as they
are. A BPE file holds merge ranks instead; its pieces get the log of Zipf's law over their rank, rounded to multiples
of 1/64 so that sums are exact and ties are real ties.

Texts are normalised as such models do it: a space becomes the marker U+2581, one marker is put in front of a text that
is not empty, nothing else changes. A character without a piece of its own costs ``UNKNOWN`` less than the worst
piece and is written as its bytes' pieces. Of equally good segmentations the one whose last piece starts earliest is
taken, from the end backwards, as the library does.

As no piece has a marker behind another character, a text falls apart at the start of each run of markers; equal parts
are segmented once, all distinct parts of a slice side by side.

Null and empty texts have no pieces; decoding none gives the empty text. Other columns pass through, columns named as
results are replaced.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyline.llm.blocks import tidy
from tallyline.llm.bpe import PartEncoder
from tallyline.llm.tables import add_text_columns, fields, table, without

MARKER = "▁"
SPACE = 0x20
UNKNOWN = 10.0
#: Parts of more bytes are segmented one at a time, in time linear in their length.
SIDE_BY_SIDE = 256
DECODED_AT_ONCE = 1 << 18


class DoubleArray:
    """A trie over byte strings: the child of node s by byte c is ``base[s] + c + 1``, if ``check`` there is s."""

    def __init__(self, keys: dict[bytes, int]):
        ordered = sorted(keys)
        size = 1 << 17
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        taken = np.zeros(size, bool)
        taken[0] = True
        free, high, todo = 1, 1, [(0, 0, len(ordered), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if len(ordered[lo]) == depth:
                self.value[node] = keys[ordered[lo]]
                lo += 1
            if lo == hi:
                continue
            groups, first = [], lo
            for k in range(lo + 1, hi + 1):
                if k == hi or ordered[k][depth] != ordered[first][depth]:
                    groups.append((ordered[first][depth], first, k))
                    first = k
            if max(free, high) + 5000 > len(taken):
                more = len(taken)
                taken = np.concatenate([taken, np.zeros(more, bool)])
                self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
                self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])
                self.value = np.concatenate([self.value, np.full(more, -1, np.int32)])
            while taken[free]:
                free += 1
            bytes_ = np.array([c for c, _, _ in groups])
            if len(groups) == 1 and free > bytes_[0]:
                at = free - int(bytes_[0]) - 1
            else:  # the first place among the next ones where all children fit
                places = np.r_[max(free - int(bytes_[0]) - 1, 0) : free + 4000, high]
                at = int(places[np.argmax(~taken[places[:, None] + bytes_ + 1].any(1))])
            self.base[node] = at
            high = max(high, at + groups[-1][0] + 2)
            for c, a, b in groups:
                taken[at + c + 1] = True
                self.check[at + c + 1] = node
                todo.append((at + c + 1, a, b, depth + 1))
            if len(groups) > 1 and taken[free : free + 1000].mean() > 0.95:
                free += 1000  # a crowded stretch is not searched again
        # any byte may be asked of any node
        self.base = np.concatenate([self.base, np.zeros(258, np.int32)])
        self.check = np.concatenate([self.check, np.full(258, -1, np.int32)])


def _char_bytes(first: np.ndarray) -> np.ndarray:
    """How many bytes a UTF-8 character has that starts with this one."""
    return np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))


class Pieces(PartEncoder):
    """A vocabulary: pieces, log scores, byte pieces; encodes and decodes."""

    def __init__(self, path: str, scores: str = "auto"):
        super().__init__()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.unknown = model.unk_id()
        self.byte_id = np.full(256, -1, np.int32)
        self.surface: list[bytes] = []
        self.is_byte = np.zeros(n, bool)
        normal = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.is_byte[i] = True
                self.surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unused(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                normal.append(i)
                self.surface.append(piece.replace(MARKER, " ").encode())
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        if any(b" " in self.surface[i].lstrip(b" ") for i in normal):
            raise ValueError("a piece with a marker behind another character")
        own = np.array([model.get_score(i) for i in range(n)])
        ranked = scores == "rank" or scores == "auto" and bool((own[normal] <= -1000).any())
        if ranked:
            order = sorted(normal, key=lambda i: (-own[i], i))
            whole = math.log(sum(1 / r for r in range(1, len(order) + 1)))
            own[:] = 0
            for r, i in enumerate(order, 1):
                own[i] = round(64 * (-math.log(r) - whole)) / 64
        self.scores = own
        self.worst = float(own[normal].min()) - UNKNOWN
        self.trie = DoubleArray({self.surface[i]: i for i in reversed(normal)})
        self.longest = max(len(self.surface[i]) for i in normal)
        self.lengths = np.array([len(s) for s in self.surface], np.int64)
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        self.begin = np.cumsum(self.lengths) - self.lengths

    def boundaries(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        starts = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            starts[1:-1] = (data[1:] == SPACE) & (data[:-1] != SPACE)
        starts[at] = True
        starts[len(data)] = False
        return np.flatnonzero(starts)

    def encode_parts(self, data, starts, ends):
        lengths = ends - starts
        found = []
        edges = [0, 4, 6, 8, 10, 12, 16, 24, 40, 64, 128, SIDE_BY_SIDE]
        for low, high in zip(edges, edges[1:]):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            step = max(1, (1 << 20) // high)
            for a in range(0, len(rows), step):
                part = rows[a : a + step]
                found.append(self._side_by_side(data, starts[part], lengths[part], part))
        for row in np.flatnonzero(lengths > SIDE_BY_SIDE):
            found.append(self._alone(data[starts[row] : ends[row]].tobytes(), int(row)))
        owner = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]])
        ids = np.concatenate([np.zeros(0, np.int32), *[f[1] for f in found]])
        counts = np.bincount(owner, minlength=len(starts)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
        begin = np.zeros(len(starts), np.int64)
        begin[owner[first]] = first
        return begin, counts, ids

    def _side_by_side(self, data, starts, lengths, numbers):
        """Owners and ids of many short parts, in order within each part."""
        n, width = len(starts), int(lengths.max())
        columns = np.arange(width)
        text = data[np.minimum(starts[:, None] + columns, len(data) - 1)]
        opens = (text & 0xC0) != 0x80
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, width + 1), np.int32)
        piece = np.full((n, width + 1), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for i in range(width):
            rows = np.flatnonzero((lengths > i) & opens[:, i])
            size = _char_bytes(text[rows, i])
            whole = np.zeros(n, bool)
            here, node, char = rows, np.zeros(len(rows), np.int64), size
            for k in range(i, min(i + self.longest, width)):
                alive = lengths[here] > k
                here, node, char = here[alive], node[alive], char[alive]
                child = base[node] + text[here, k].astype(np.int64) + 1
                alive = check[child] == node
                here, node, char = here[alive], child[alive], char[alive]
                if not len(here):
                    break
                ids = value[node]
                hit = ids >= 0
                at, ids = here[hit], ids[hit]
                whole[at[char[hit] == k + 1 - i]] = True
                score = best[at, i] + self.scores[ids]
                better = score > best[at, k + 1]
                at, ids = at[better], ids[better]
                best[at, k + 1], back[at, k + 1], piece[at, k + 1] = score[better], i, ids
            lone = ~whole[rows]
            at, upto = rows[lone], i + size[lone]
            score = best[at, i] + self.worst
            better = score > best[at, upto]
            at, upto = at[better], upto[better]
            best[at, upto], back[at, upto], piece[at, upto] = score[better], i, -1
        rows, at = np.arange(n), lengths.copy()
        owners, ids, begins, order = [], [], [], []
        step = 0
        while len(rows):
            owners.append(rows)
            ids.append(piece[rows, at])
            before = back[rows, at].astype(np.int64)
            begins.append(before)
            order.append(np.full(len(rows), step))
            step -= 1
            rows, at = rows[before > 0], before[before > 0]
        owners, ids, begins, order = map(np.concatenate, (owners, ids, begins, order))
        by = np.lexsort((order, owners))
        owners, ids, begins = owners[by], ids[by], begins[by]
        lone = ids < 0
        if lone.any():
            size = np.where(lone, _char_bytes(text[owners, begins]), 1)
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            owners, ids, begins, lone = (np.repeat(x, size) for x in (owners, ids, begins, lone))
            ids = np.where(lone, self.byte_id[text[owners, np.minimum(begins + place, width - 1)]], ids)
        return numbers[owners], ids.astype(np.int32)

    def _alone(self, raw: bytes, number: int):
        n, base, check, value = len(raw), self._base, self._check, self._value
        best, back, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        scores = self._score_list
        i = 0
        while i < n:
            c = raw[i]
            size = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
            node, whole, so_far = 0, False, best[i]
            for k in range(i, min(i + self.longest, n)):
                child = base[node] + raw[k] + 1
                if check[child] != node:
                    break
                node = child
                if value[node] >= 0:
                    whole = whole or k + 1 - i == size
                    score = so_far + scores[value[node]]
                    if score > best[k + 1]:
                        best[k + 1], back[k + 1], piece[k + 1] = score, i, value[node]
            if not whole and so_far + self.worst > best[i + size]:
                best[i + size], back[i + size], piece[i + size] = so_far + self.worst, i, -1
            i += size
        ids, at = [], n
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids.extend(int(self.byte_id[b]) for b in reversed(raw[back[at] : at]))
            at = back[at]
        return np.full(len(ids), number), np.array(ids[::-1], np.int32)

    @property
    def _base(self):
        if not hasattr(self, "_lists"):
            self._lists = [x.tolist() for x in (self.trie.base, self.trie.check, self.trie.value, self.scores)]
        return self._lists[0]

    @property
    def _check(self):
        return self._lists[1]

    @property
    def _value(self):
        return self._lists[2]

    @property
    def _score_list(self):
        return self._lists[3]

    def encode_texts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the number of each, of texts as they are (not yet normalised)."""
        if len(data) > 2:
            literal = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            if literal.any():  # a marker in the text itself is a space from here on
                at_marker = np.flatnonzero(literal)
                keep = np.ones(len(data), bool)
                keep[at_marker + 1] = keep[at_marker + 2] = False
                data = data.copy()
                data[at_marker] = SPACE
                at = np.r_[0, np.cumsum(keep)][at]
                data = data[keep]
        full = np.diff(at) > 0
        data = np.insert(data, at[:-1][full], SPACE)
        at = at + np.r_[0, np.cumsum(full)]
        return self.encode(data, at)

    def decode_ids(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The text of each run of ids: markers become spaces, the first one goes, byte pieces join as UTF-8."""
        size = self.lengths[ids]
        reach = np.cumsum(size)
        place = np.repeat(self.begin[ids] - (reach - size), size)
        raw = self.flat[place + np.arange(len(place))].tobytes()
        begins = np.r_[0, ends]
        cuts = np.r_[0, reach][begins].tolist()
        marked = np.r_[~self.is_byte[ids], False][begins[:-1]].tolist() if len(ends) else []
        out = []
        for a, b, first in zip(cuts, cuts[1:], marked):
            part = raw[a + 1 : b] if first and raw[a : a + 1] == b" " else raw[a:b]
            try:
                out.append(part.decode())
            except UnicodeDecodeError:
                out.append(_lenient(part))
        return out


def _lenient(raw: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that belongs to no character."""
    out, i = [], 0
    while i < len(raw):
        size = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
        try:
            out.append(raw[i : i + size].decode())
            i += size
        except UnicodeDecodeError:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(maxsize=2)
def pieces(path: str, scores: str = "auto") -> Pieces:
    return Pieces(path, scores)


def encode_pieces(
    docs: DataFrame, model: str, text: str = "text", scores: str = "auto", check: bool = False, drop_text: bool = False
) -> DataFrame:
    """Adds ``pieces`` (ids), ``n_pieces`` and ``n_byte_pieces`` to each row.

    With ``check`` the ids are decoded at once, and ``round_trip`` says whether they give the text again (a marker in
    the text itself comes back as a space)."""

    def maker():
        own = pieces(model, scores)

        def compute(data, at):
            ids, counts = own.encode_texts(data, at)
            ends = np.cumsum(counts)
            fallen = np.r_[0, np.cumsum(own.is_byte[ids])]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32()))
            out = [lists, counts, fallen[ends] - fallen[ends - counts]]
            if check:
                decoded, cuts, raw = own.decode_ids(ids, ends), at.tolist(), data.tobytes()
                spaced = (raw[a:b].replace(MARKER.encode(), b" ") for a, b in zip(cuts, cuts[1:]))
                out.append([t.encode() == s for t, s in zip(decoded, spaced)])
            return out

        return compute

    named = fields(pieces="ints", n_pieces="long", n_byte_pieces="long", **({"round_trip": "boolean"} if check else {}))
    return add_text_columns(docs, text, named, maker, drop_text)


def decode_pieces(encoded: DataFrame, model: str, ids: str = "pieces", scores: str = "auto") -> DataFrame:
    """Adds ``decoded``, the text of each row's ids; null ids give null."""
    rest = without(encoded, ["decoded"])
    kept = rest.columns
    schema = T.StructType([*rest.schema, T.StructField("decoded", T.StringType())])

    def run(batches):
        own = pieces(model, scores)
        for batch in tidy(batches):
            column = batch.column(kept.index(ids))
            lengths = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), 0), np.int64)
            values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
            parts, a = [], 0
            while a < len(ends):  # some rows at a time, so that what is made of them stays small
                done = int(ends[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(ends, done + DECODED_AT_ONCE, "right")))
                parts.append(pa.array(own.decode_ids(values[done : int(ends[b - 1])], ends[a:b] - done), pa.string()))
                a = b
            texts = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
            texts = pa.compute.if_else(column.is_valid(), texts, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*kept, "decoded"])

    return rest.mapInArrow(run, schema)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_pieces(docs, model, check=True, drop_text=True)
    return coded.select("doc_id", "n_pieces", "n_byte_pieces", "pieces", "round_trip")
