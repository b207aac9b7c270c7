"""Plain versions of what the operators compute, and rows at the edges."""

import re
from collections import Counter, defaultdict

import numpy as np

from tallyline.llm.blocks import _BASE, _RANDOM, mix, span_hashes

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SMALL = "/root/testdata/sf0.001"


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def texts_of(spark, sf_dir=SMALL):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def edge_docs(spark, extra=()):
    """Null, empty, blank, one-word, repeated and very long texts; columns that clash with results and inner names."""
    long = " ".join(f"word{i % 977} And{i % 13}" for i in range(30_000))
    rows = [
        (None, None), (None, "some text without an id"), (1, None), (2, ""), (3, " \n\t\n"), (4, "lone"), (5, "lone"),
        (6, "the same row twice, and nothing else in it but this"), (6, "the same row twice, and nothing else in it but this"),
        (7, long), (8, long + " more"), (9, "x" * 70_000), (10, "漢字 é \U00013000 ▁ a\x00b\n\n"), *extra,
    ]
    clash = ("row", "id", "hash", "n", "kept", "score", "pieces", "spans", "n_tokens", "label", "rep", "block")
    rows = [(*r, *range(len(clash))) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` long" for c in clash))


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def near_duplicates(texts, percent=85):
    sets = {}
    for i, x in texts.items():
        w = words(x, lower=True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        shared = Counter(j for z in s for j in index[z])
        for z in s:
            index[z].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def dedup_lines(texts, seeds=None, long_words=None):
    from tallyline.llm import line_chunks as L

    places = defaultdict(set)
    for i, x in texts.items():
        if not x:
            continue
        raw, lines, at = x.encode(), [], 0
        for line in raw.split(b"\n"):
            lines.append((at, at + len(line), line))
            at += len(line) + 1
        hashes = span_hashes(
            np.frombuffer(raw, np.uint8), np.array([a for a, _, _ in lines]), np.array([b for _, b, _ in lines]), _RANDOM
        )
        n = [len(re.findall(rb"[^\x20\x09-\x0D]+", line)) for _, _, line in lines]
        for (a, b, line), w in zip(lines, n):
            if w >= L.LONG_WORDS:
                places["long", line].add((i, a, b))
        for seed in range(1, L.SEEDS + 1):
            first = 0
            for k in range(len(lines)):
                rolled = int(hashes[k]) * (2 * seed + 1)
                if seed % 2 == 0 and k:
                    rolled += int(hashes[k - 1]) * int(_BASE)
                closes = int(mix(np.array([rolled % (1 << 64)], np.uint64))[0]) % L.MODULUS == 0
                if closes or n[k] >= L.LONG_WORDS or k == len(lines) - 1 or n[k + 1] >= L.LONG_WORDS:
                    if k > first and sum(n[first : k + 1]) >= L.LEAST_WORDS:
                        places[seed, raw[lines[first][0] : lines[k][1]]].add((i, lines[first][0], lines[k][1]))
                    first = k + 1
    gone = defaultdict(list)
    for found in places.values():
        for i, a, b in sorted(found)[1:]:
            gone[i].append((a, b))
    out = {}
    for i, x in texts.items():
        if not x:
            out[i] = x
            continue
        kept, at = [], 0
        for line in x.encode().split(b"\n"):
            if not any(a <= at and at + len(line) <= b for a, b in gone[i]):
                kept.append(line)
            at += len(line) + 1
        out[i] = b"\n".join(kept).decode()
    return out


def plain(text):
    """Lower-cased, with one space for each run of ASCII characters that are neither letters nor digits."""
    return re.sub(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ", (text or "").translate(LOWER))


def contaminated(texts, items):
    """Ids of the texts that hold the whole of an item, normalised."""
    needles = [plain(x).strip() for x in items if x]
    needles = [n for n in needles if len(n.encode()) >= 32]
    return {i for i, x in ((i, plain(x)) for i, x in texts.items()) if any(n in x for n in needles)}


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def rule_counts(text):
    text = text or ""
    w = words(text)
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    full = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(repeated), failed


def clashing(docs):
    """``docs`` with more columns, named as columns that the operators use inside or give back."""
    from pyspark.sql import functions as F

    names = ("__row", "__gone", "__hit", "__spans", "__found", "__left", "__terms", "row", "id", "gone", "hit", "spans", "terms",
             "removed_bytes", "score", "predicted", "kept", "c0", "hash", "label", "order", "n", "own_row", "a.b")
    own = [n for n in names if n not in docs.columns]
    return docs.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in own]), own
