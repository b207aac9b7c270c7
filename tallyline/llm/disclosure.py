"""Personal data, and the terms that give it away: information-theoretic sanitisation.

Base spans are e-mail addresses, IPv4 addresses, payment card numbers and phone numbers, matched over whole texts, leftmost
and without overlap per kind. Each pattern is searched in time linear in the text.

A *context* is a line that holds base spans; its *entities* are their values, its *terms* the words beside them, lower-cased
and without punctuation at their ends. Over all lines of all documents, N of them,

    IC(e) = log(N / n(e))          what it takes to name the entity
    PMI(t, e) = log(n(t, e) * N / (n(t) * n(e)))     how much of that the term already tells

A term discloses an entity if it tells at least ``GENERALISE`` of it: PMI / IC. It is then generalised to its shape
(letters to x, digits to 0) and, from ``REMOVE`` on, removed, wherever it stands in a document that holds the entity. It must stand next to the entity in ``CONTEXTS`` different lines: of a
line that was merely copied, every rare word would "disclose". Counts are of lines, copies included, as readers see them.

Null and empty texts have no spans. Equal rows get equal results. Columns named as results are replaced.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.blocks import _RANDOM, FOLDED, span_hashes, text_slices, word_spans, tidy
from tallyline.llm.line_chunks import lines_of
from tallyline.llm.tables import aliased, near, restored, table
from tallyline.session import saved

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
GENERALISE = 0.8
REMOVE = 0.95
CONTEXTS = 2
SHORTEST_TERM = 3
#: Up to so many candidate terms (8 bytes each) go to all tasks; beyond it all words are joined with them.
BROADCAST_TERMS = 1 << 20

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit run has no match inside it where it has none from its start
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str):
    after = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            after = found.end()
        at = text.find("@", max(at + 1, after))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind (its place in ``KINDS``), start and end in code points, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def _shown(spans, names) -> str:
    return ",".join(f"{names[k]}:{s}:{e}" for k, s, e in spans)


_EDGE = re.compile(r"\A[^\w]*(.*?)[^\w]*\Z", re.S)


def _entities(text: str, spans) -> list[str]:
    return sorted({f"{k}:{text[s:e].lower()}" for k, s, e in spans})


def _contexts(text: str, spans):
    """For each line with spans its entities and its terms."""
    by_line: dict[tuple[int, int], list] = {}
    for k, s, e in spans:
        a = text.rfind("\n", 0, s) + 1
        b = text.find("\n", e)
        by_line.setdefault((a, len(text) if b < 0 else b), []).append((k, s, e))
    for (a, b), held in sorted(by_line.items()):
        terms = []
        for m in re.finditer(r"[^\x20\x09-\x0d]+", text[a:b]):
            s, e = a + m.start(), a + m.end()
            if any(s < y and x < e for _, x, y in held):
                continue
            core = _EDGE.match(m.group())
            s, e = s + core.start(1), s + core.end(1)
            if e - s >= SHORTEST_TERM:
                terms.append(text[s:e])
        yield text[a:b], _entities(text, held), terms


def _hashes(strings: list[str], table_) -> np.ndarray:
    """The hash of each string, as ``span_hashes`` gives it anywhere in a text."""
    raw = [s.encode() for s in strings]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    return span_hashes(data, np.r_[0, ends[:-1]].astype(np.int64), ends, table_).view(np.int64)


@cache
def _wordy() -> np.ndarray:
    """Which code points are ``\\w``."""
    return np.array([chr(c).isalnum() or c == 0x5F for c in range(0x110000)])


def _characters(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the characters that begin at these bytes are ``\\w``, and how many bytes each has."""
    code = data[at].astype(np.int64)
    size = 1 + (code >= 0xC0) + (code >= 0xE0) + (code >= 0xF0)
    more = np.flatnonzero(size > 1)
    code[more] &= 0xFF >> (size[more] + 1)
    for k in range(1, 4):
        more = more[size[more] > k]
        code[more] = code[more] << 6 | data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F
    return _wordy()[np.minimum(code, 0x10FFFF)], size


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans trimmed as ``_EDGE`` does; words of nothing else are dropped."""
    starts, ends = starts.copy(), ends.copy()
    move = np.arange(len(starts))
    while len(move):
        wordy, size = _characters(data, starts[move])
        starts[move[~wordy]] += size[~wordy]
        move = move[~wordy]
        move = move[starts[move] < ends[move]]
    move = np.flatnonzero(starts < ends)
    while len(move):
        last = ends[move] - 1
        for _ in range(3):
            last -= ((data[last] & 0xC0) == 0x80) & (last > starts[move])
        wordy, _ = _characters(data, last)
        move, last = move[~wordy], last[~wordy]
        ends[move] = last
        move = move[starts[move] < ends[move]]
    keep = starts < ends
    return starts[keep], ends[keep]


_PLACES = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("entity", "context", "term")]))
_SPANS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("kind", "start", "end")]))


def find_base(docs: DataFrame) -> DataFrame:
    """For rows of ``row``, ``id``, ``text``: the number of lines, the base spans, their entities, and the terms beside them."""
    kind = docs.schema["id"]
    schema = T.StructType([
        T.StructField("row", T.LongType()), kind, T.StructField("lines", T.LongType()),
        T.StructField("spans", _SPANS), T.StructField("entities", T.ArrayType(T.LongType())), T.StructField("places", _PLACES),
    ])

    def run(batches):
        span_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("kind", "start", "end")]))
        place_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("entity", "context", "term")]))
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(2)):
                n = len(at) - 1
                def has(flags):
                    reach = np.r_[0, np.cumsum(flags)]
                    return reach[at[1:]] - reach[at[:-1]]
                lines = has(data == 10) + (np.diff(at) > 0)
                digits = has((data >= 0x30) & (data <= 0x39))
                spans: list = [[] for _ in range(n)]
                entities: list = [[] for _ in range(n)]
                places: list = [[] for _ in range(n)]
                for i in np.flatnonzero((has(data == 0x40) > 0) | (digits >= 4)).tolist():
                    text = data[at[i] : at[i + 1]].tobytes().decode()
                    found = base_spans(text)
                    if not found:
                        continue
                    spans[i] = [dict(zip(("kind", "start", "end"), s)) for s in found]
                    entities[i] = _hashes(_entities(text, found), _RANDOM).tolist()
                    for line, beside, terms in _contexts(text, found):
                        if terms:
                            own = _hashes(beside, _RANDOM).tolist()
                            context = _hashes([line], _RANDOM).tolist()[0]
                            for t in _hashes(terms, FOLDED).tolist():
                                places[i] += [{"entity": x, "context": context, "term": t} for x in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(lines, pa.int64()),
                        pa.array(spans, span_type), pa.array(entities, pa.list_(pa.int64())), pa.array(places, place_type),
                    ],
                    names=schema.names,
                )

    return docs.select("row", "id", "text").mapInArrow(run, schema)


def _shared(terms: DataFrame):
    """The terms in order, for all tasks, or None if they are too many."""
    if terms.count() > BROADCAST_TERMS:
        return None
    return terms.sparkSession.sparkContext.broadcast(np.sort(np.array([r["term"] for r in terms.collect()], np.int64)))


def _among(own: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(own, hashes), max(len(own) - 1, 0))
    return own[place] == hashes if len(own) else np.zeros(len(hashes), bool)


def lines_with(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term``, ``n``: in how many lines of all documents each of the given terms stands."""
    wanted = _shared(terms)

    def run(batches):
        if wanted is not None:  # one row per term and task
            total = np.zeros(len(wanted.value), np.int64)
            for found, n in counted(batches):
                total[np.searchsorted(wanted.value, found)] += n
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(wanted.value[used]), pa.array(total[used])], names=["term", "n"])
            return
        for found, n in counted(batches):
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n, pa.int64())], names=["term", "n"])

    def counted(batches):
        for batch in tidy(batches):
            for _, data, at in text_slices(batch.column(0)):
                starts, ends = _trimmed(data, *word_spans(data, at)) if len(data) else word_spans(data, at)
                line_starts, *_ = lines_of(data, at)
                hashes = span_hashes(data, starts, ends, FOLDED).view(np.int64)
                line = np.searchsorted(line_starts, starts, "right")
                if wanted is not None:
                    keep = _among(wanted.value, hashes)
                    hashes, line = hashes[keep], line[keep]
                order = np.lexsort((line, hashes))
                hashes, line = hashes[order], line[order]
                new = np.r_[True, (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])] if len(hashes) else np.zeros(0, bool)
                yield np.unique(hashes[new], return_counts=True)

    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counts if wanted is not None else counts.join(terms, "term", "left_semi")


def places_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """For rows of ``row``, ``text``, ``spans``: ``row``, ``term``, ``start``, ``end`` (code points) of each of the given
    terms on any line, but not in words that a base span touches."""
    wanted = _shared(terms)

    def run(batches):
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(1)):
                if not len(data):
                    continue
                words = word_spans(data, at)
                starts, ends = _trimmed(data, *words)
                hashes = span_hashes(data, starts, ends, FOLDED).view(np.int64)
                if wanted is not None:
                    keep = _among(wanted.value, hashes)
                    starts, ends, hashes = starts[keep], ends[keep], hashes[keep]
                point = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                spans = batch.column(2).slice(first, len(at) - 1)
                base = np.repeat(point[at[:-1]], pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
                edges = np.zeros(point[-1] + 2, np.int64)
                np.add.at(edges, base + pc.struct_field(spans.flatten(), "start").to_numpy(zero_copy_only=False), 1)
                np.add.at(edges, base + pc.struct_field(spans.flatten(), "end").to_numpy(zero_copy_only=False), -1)
                covered = np.r_[0, np.cumsum(np.cumsum(edges) > 0)]
                whole = np.searchsorted(words[0], starts, "right") - 1
                free = covered[point[words[0][whole]]] == covered[point[words[1][whole]]]
                free &= point[ends] - point[starts] >= SHORTEST_TERM
                starts, ends, hashes = starts[free], ends[free], hashes[free]
                owner = np.searchsorted(at, starts, "right") - 1
                begin = point[at[owner]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner + first)), pa.array(hashes),
                        pa.array(point[starts] - begin), pa.array(point[ends] - begin),
                    ],
                    names=["row", "term", "start", "end"],
                )

    places = docs.select("row", "text", "spans").mapInArrow(run, "row long, term long, start long, end long")
    return places if wanted is not None else places.join(terms, "term", "left_semi")


def disclosing_terms(base: DataFrame, docs: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """``entity``, ``term`` and ``share`` (PMI / IC) of the terms that disclose an entity."""
    places = base.select("row", F.explode("places").alias("p")).select("row", "p.entity", "p.context", "p.term")
    contexts = places.groupBy("entity", "term", "context").agg(F.countDistinct("row").alias("n"))
    pairs = saved(
        contexts.groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("n").alias("both"))
        .where(F.col("contexts") >= CONTEXTS), "pairs"
    )
    of_entity = places.select("entity", "context", "row").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    total = float(base.agg(F.sum("lines")).first()[0] or 1)
    # a term that the contexts alone show to be too common for the threshold needs no count over all lines
    here = places.select("term", "context", "row").distinct().groupBy("term").agg(F.count("*").alias("n_here"))
    most = F.col("both") * F.pow(F.lit(total) / F.col("n_entity"), F.lit(1 - generalise)) * (1 + 1e-9)
    open_ = saved(pairs.join(of_entity, "entity").join(here, "term").where(F.col("n_here") <= most), "open_pairs")
    of_term = lines_with(docs, open_.select("term").distinct())
    known = open_.join(of_term.withColumnRenamed("n", "n_term"), "term")
    pmi = F.log(F.col("both") * F.lit(total) / (F.col("n_term") * F.col("n_entity")))
    share = pmi / F.log(F.lit(total) / F.col("n_entity"))
    return known.select("entity", "term", share.alias("share")).where(F.col("share") >= generalise)


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", generalise: float = GENERALISE) -> DataFrame:
    """``row`` and ``id`` of each row, ``spans`` (kind, start, end) of the base, ``terms`` (start, end, share) added."""
    keyed = docs.select(
        F.xxhash64(F.col(doc_id), F.col(text)).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text")
    )
    base = saved(find_base(keyed), "base")
    found = saved(disclosing_terms(base, keyed, generalise), "disclosing")
    held = base.select("row", F.explode("entities").alias("entity")).distinct()
    held = saved(held.join(near(found.select("entity").distinct()), "entity", "left_semi"), "held")
    holders = base.join(held.select("row").distinct(), "row", "left_semi").select("row", "spans").dropDuplicates(["row"])
    holders = saved(holders, "holders")
    texts = keyed.join(near(holders, holders.select(F.explode("spans"))), "row")
    terms = (
        places_of(texts, found.select("term").distinct()).join(near(found), "term")
        .join(held, ["row", "entity"], "left_semi")
        .groupBy("row", "start", "end").agg(F.max("share").alias("share"))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    )
    return base.select("row", "id", "spans").join(terms, "row", "left")


def _kind_name(kind):
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), (kind + 1).cast("int"))


def span_digests(found: DataFrame) -> DataFrame:
    """The result of ``find_personal_data`` as counts, a digest of the base spans and a list of all spans as text."""
    base = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", _kind_name(s["kind"]), s["start"], s["end"])))
    more = F.transform(F.coalesce("terms", F.expr("array()")), lambda s: F.concat_ws(":", F.lit(TERM), s["start"], s["end"]))
    counts = [
        F.size(F.expr(f"filter(spans, s -> s.kind = {k})")).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)
    ]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.size("spans") > 0, base), F.when(F.size(more) > 0, F.concat_ws(",", more))).alias("spans"),
    )


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``docs`` with base spans replaced by their kind, and disclosing terms by their shape or removed."""
    found = find_personal_data(docs, doc_id, text, generalise).dropDuplicates(["row"]).where("size(spans) > 0")
    found = found.select("row", "spans", "terms")
    plain, names = aliased(docs)
    id_, text_ = (names[docs.columns.index(c)] for c in (doc_id, text))
    rewrite = F.udf(lambda t, spans, terms: _rewritten(t, spans, terms or [], remove), "string", useArrow=True)
    keyed = plain.withColumn("own_row", F.xxhash64(id_, text_))
    touched = keyed.join(found, F.col("own_row") == F.col("row"))
    touched = touched.select(*[rewrite(text_, "spans", "terms").alias(c) if c == text_ else F.col(c) for c in names])
    rest = keyed.join(found, F.col("own_row") == F.col("row"), "left_anti")
    return restored(touched.union(rest.select(names)), names, docs.columns)


def _rewritten(text: str, spans, terms, remove: float) -> str:
    cuts = [(s["start"], s["end"], f"<{KINDS[s['kind']].upper()}>") for s in spans]
    for t in terms:
        word = text[t["start"] : t["end"]]
        shape = re.sub(r"[^\W\d_]", "x", re.sub(r"\d", "0", word))
        cuts.append((t["start"], t["end"], "" if t["share"] >= remove else shape))
    out, at = [], 0
    for s, e, new in sorted(cuts):
        if s >= at:
            out += [text[at:s], new]
            at = e
        elif e > at:  # kinds may overlap: the first one's name stands for both
            at = e
    return "".join([*out, text[at:]])


def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(find_personal_data(table(spark, sf_dir, "documents")))
