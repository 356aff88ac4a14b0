"""Measured tuning of retrieval: every chunking, search mode and depth over every case.

One table of postings (a document's terms, token by token) serves all chunkings: the place of a
token gives the chunks that hold it under any size and overlap, so counts, lengths, document frequencies and vectors of
chunks are sums over place ranges.  Documents and cases are cut into blocks of bounded size, a pair of blocks is
scored in one task for all chunkings, and only the best chunks of each case leave it.  What the modes retrieve is then
judged on the chunks' own words.

Vectors are hashed bags of words: there is no embedding model here, and one that only knows whole
documents could not tell chunkings apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.functions.scalars import words
from mortarline.operators.experiments import cost, grid_array
from mortarline.session import cut_lineage

DIGITS = 6
#: Slots of a hashed vector.
SLOTS = 64
#: Terms of documents, and cases, that meet in one task, and terms that are scored there at a time.
BLOCK_TERMS, BLOCK_CASES, SLICE_TERMS = 2_000_000, 256, 150_000
#: Rows of a table that is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Weight of each measured score in the composite.
WEIGHTS = {"hit": 0.5, "coverage": 0.3, "reciprocal_rank": 0.2}
MODES = ("vector", "hybrid", "keyword_semantic")


def text_tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def posting_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, packed): the terms of a document's white-space tokens in order, one line per token.

    Packed into one string they take a third of what arrays of terms and places take in a shuffle.  Documents are dealt
    anew first, as a file of few row groups would leave them to few tasks.
    """
    dealt = docs.where(F.col(key).isNotNull()).select(key, text).repartition(key)
    split = dealt.select(F.col(key).cast("long").alias("doc_id"), F.explode(F.array(text_tokens(F.col(text)))).alias("_t"))
    packed = F.array_join(F.transform("_t", lambda w: F.array_join(words(w), " ")), "\n")
    return split.where(F.size("_t") > 0).select("doc_id", F.size("_t").alias("n_tokens"), packed.alias("packed"))


def chunk_totals(postings: DataFrame, chunkings: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """(chunks, tokens in them) of each (size, overlap), from one aggregate of closed forms."""
    sums = []
    for i, (size, overlap) in enumerate(chunkings):
        step, n = size - overlap, F.col("n_tokens")
        chunks = F.floor(F.greatest(F.lit(0), n - overlap - 1) / step) + 1
        # at most the last chunk is short
        whole = F.least(chunks, F.greatest(F.lit(0), F.floor((n - size) / step) + 1))
        sums += [F.sum(chunks).alias(f"c{i}"), F.sum(whole * size + (chunks - whole) * (n - (chunks - 1) * step)).alias(f"t{i}")]
    row = postings.agg(*sums).first()
    return [(row[f"c{i}"] or 0, row[f"t{i}"] or 0) for i in range(len(chunkings))]


def _slices(n_tokens: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first row, rows) of parts with some SLICE_TERMS tokens each, one row at least, whatever the size of a batch."""
    upto, begin = np.cumsum(n_tokens), 0
    while begin < len(upto):
        before = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + SLICE_TERMS, "right")))
        yield begin, end - begin
        begin = end


class Block:
    """Postings of some documents as flat arrays: term, place and document of each."""

    def __init__(self, n_tokens: np.ndarray, packed: pa.Array):
        self.n_tokens = n_tokens.astype(np.int64)
        lines = pc.split_pattern(packed, "\n").flatten()
        parts = pc.split_pattern(lines, " ")
        n = parts.value_lengths().to_numpy(zero_copy_only=False)
        coded = parts.flatten().dictionary_encode()
        self.words = coded.dictionary.to_pylist()
        term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(self.n_tokens)
        place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - self.n_tokens, self.n_tokens)
        doc = np.repeat(np.arange(len(n_tokens)), self.n_tokens)
        # a token of signs alone has no terms
        known = term != self.words.index("") if "" in self.words else np.ones(len(term), bool)
        self.term, self.place, self.doc = term[known], np.repeat(place, n)[known], np.repeat(doc, n)[known]

    def chunks(self, size: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, number, tokens) of all chunks, documents in order."""
        step = size - overlap
        n = np.maximum(0, self.n_tokens - overlap - 1) // step + 1
        doc = np.repeat(np.arange(len(n)), n)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        return doc, number, np.minimum(size, self.n_tokens[doc] - number * step)

    def spread(self, size: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
        """(chunk, posting) for each chunk that holds a posting's place."""
        step = size - overlap
        n = np.maximum(0, self.n_tokens - overlap - 1) // step + 1
        first = np.cumsum(n) - n
        low = np.maximum(0, (self.place - size) // step + 1)
        high = np.minimum(self.place // step, n[self.doc] - 1)
        times = high - low + 1
        which = np.repeat(np.arange(len(times)), times)
        return first[self.doc[which]] + low[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times), which


def chunk_frequencies(postings: DataFrame, chunkings: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows (term, n0, n1, ...): in how many chunks of each chunking a term occurs; counted per batch before the shuffle."""
    names = [f"n{i}" for i in range(len(chunkings))]

    def counted(part: pa.RecordBatch) -> pa.RecordBatch:
        block = Block(part.column("n_tokens").to_numpy(), part.column("packed"))
        counts, n = [], len(block.words) or 1
        for size, overlap in chunkings:
            chunk, which = block.spread(size, overlap)
            counts.append(np.bincount(np.unique(chunk * n + block.term[which]) % n, minlength=len(block.words)))
        return pa.RecordBatch.from_arrays([pa.array(block.words, pa.string()), *[pa.array(c, pa.int64()) for c in counts]], ["term", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, n in _slices(batch.column("n_tokens").to_numpy()):
                yield counted(batch.slice(begin, n))

    partial = postings.select("n_tokens", "packed").mapInArrow(run, "term string, " + ", ".join(f"{n} bigint" for n in names))
    return partial.where("term <> ''").groupBy("term").agg(*[F.sum(n).alias(n) for n in names])


@lru_cache(maxsize=200_000)
def slot_of(term: str) -> tuple[int, int]:
    """(slot, sign) of a term in hashed vectors, from its MD5 digest."""
    digest = hashlib.md5(term.encode(), usedforsecurity=False).hexdigest()
    return int(digest[:4], 16) % SLOTS, 1 if int(digest[4], 16) % 2 else -1


def _slots(terms: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    found = np.array([slot_of(t) for t in terms], np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1].astype(float)


def _top(scores: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(chunk, case) of the best positive scores per column, at least ``depth`` with their ties."""
    if len(scores) > depth:
        cut = np.partition(scores, len(scores) - depth, axis=0)[len(scores) - depth]
        return np.nonzero((scores > 0) & (scores >= cut))
    return np.nonzero(scores > 0)


def _score(docs: pa.Table, cases: pa.Table, chunkings: Sequence[tuple[int, int]], average: Sequence[float], depth: int, k1: float, b: float) -> pa.Table:
    names = ["chunking", "by_vector", "case_id", "doc_id", "chunk_no", "score", "vector_score", "candidates"]
    kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
    parts: list[list[np.ndarray]] = []
    if docs.num_rows and cases.num_rows:
        docs = docs.sort_by("doc_id").combine_chunks()
        column = lambda t, c: t.column(c).combine_chunks() if isinstance(t.column(c), pa.ChunkedArray) else t.column(c)
        block = Block(docs.column("n_tokens").to_numpy(), column(docs, "packed"))
        ids = docs.column("doc_id").to_numpy()
        case_ids, case = np.unique(cases.column("case_id").to_numpy(), return_inverse=True)
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(cases.column("term").to_pylist()))}
        wanted = np.fromiter((vocabulary[t] for t in cases.column("term").to_pylist()), np.int64, cases.num_rows)
        asked = np.zeros((len(vocabulary), len(case_ids)))
        asked[wanted, case] = 1
        idf = np.zeros((len(vocabulary), len(chunkings)))
        idf[wanted] = np.array(cases.column("idf").to_pylist(), float).reshape(-1, len(chunkings))
        slot, sign = _slots(list(vocabulary))
        q_vectors = np.zeros((len(case_ids), SLOTS))
        np.add.at(q_vectors, (case, slot[wanted]), sign[wanted] * cases.column("n").to_numpy())
        own = np.array([vocabulary.get(w, -1) for w in block.words], np.int64)
        w_slot, w_sign = _slots(block.words)
        q_norm = np.sqrt((q_vectors**2).sum(1))
        for number, (size, overlap) in enumerate(chunkings):
            doc, chunk_no, tokens = block.chunks(size, overlap)
            chunk, which = block.spread(size, overlap)
            term = block.term[which]
            vectors = np.bincount(chunk * SLOTS + w_slot[term], weights=w_sign[term], minlength=len(doc) * SLOTS).reshape(-1, SLOTS)
            norm = np.sqrt((vectors**2).sum(1))[:, None] * q_norm[None, :]
            by_vector = np.round(np.divide(vectors @ q_vectors.T, norm, out=np.zeros_like(norm), where=norm > 0), DIGITS)
            known = own[term] >= 0
            held, tf = np.unique(chunk[known] * (len(vocabulary) or 1) + own[term[known]], return_counts=True)
            at, t = held // (len(vocabulary) or 1), held % (len(vocabulary) or 1)
            gain = idf[t, number] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * tokens[at] / average[number]))
            by_keyword = np.zeros_like(by_vector)
            for low in range(0, len(doc), 1024):
                span = slice(*np.searchsorted(at, [low, low + 1024]))
                met, place = np.unique(t[span], return_inverse=True)
                dense = np.zeros((min(1024, len(doc) - low), len(met)))
                dense[at[span] - low, place] = gain[span]
                by_keyword[low : low + 1024] = dense @ asked[met]
            by_keyword = np.round(by_keyword, DIGITS)
            for vector, scores in ((False, by_keyword), (True, by_vector)):
                row, col = _top(scores, depth)
                order = np.lexsort((row, -scores[row, col], col))
                row, col = row[order], col[order]
                first = np.searchsorted(col, col)
                kept = np.arange(len(col)) - first < depth
                opens = (np.arange(len(col)) == first)[kept]
                row, col = row[kept], col[kept]
                parts.append([
                    np.full(len(row), number), np.full(len(row), vector), case_ids[col], ids[doc[row]], chunk_no[row], scores[row, col], by_vector[row, col],
                    np.where(opens, (scores > 0).sum(0)[col], 0),
                ])
    arrays = [np.concatenate([p[i] for p in parts]) if parts else [] for i in range(len(names))]
    return pa.table([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], names=names)


def _best_of(found: pa.Table, depth: int) -> pa.Table:
    """The ``depth`` best rows per chunking, ranking and case; the candidates of all are added up on the first."""
    frame = found.to_pandas()
    key = ["chunking", "by_vector", "case_id"]
    frame = frame.sort_values([*key, "score", "doc_id", "chunk_no"], ascending=[True, True, True, False, True, True], kind="stable")
    groups = frame.groupby(key, sort=False)
    total, place = groups["candidates"].transform("sum"), groups.cumcount()
    frame["candidates"] = total.where(place == 0, 0)
    return pa.Table.from_pandas(frame[place < depth], schema=found.schema, preserve_index=False)


def _score_all(docs: pa.Table, cases: pa.Table, chunkings: Sequence[tuple[int, int]], average: Sequence[float], depth: int, k1: float, b: float) -> pa.Table:
    """``_score`` for some documents at a time; what is kept in between is the best of them."""
    if not docs.num_rows or not cases.num_rows:
        return _score(docs, cases, chunkings, average, depth, k1, b)
    docs = docs.combine_chunks()
    kept = None
    for begin, n in _slices(docs.column("n_tokens").to_numpy()):
        part = _score(docs.slice(begin, n), cases, chunkings, average, depth, k1, b)
        kept = part if kept is None else _best_of(pa.concat_tables([kept, part]), depth)
    return kept


def scored_chunks(docs: DataFrame, cases: DataFrame, chunkings: Sequence[tuple[int, int]], depth: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Rows (chunking, by_vector, case_id, doc_id, chunk_no, score, vector_score, candidates), written once.

    ``docs`` (doc_id, text), ``cases`` (case_id, text); per block of documents the ``depth`` best chunks by BM25 and by cosine of
    hashed vectors, for each case and number of chunking.  ``candidates`` adds up to the chunks with a positive score.
    """
    postings = cut_lineage(posting_table(docs))
    totals = chunk_totals(postings, chunkings)
    average = [t / c if c else 1.0 for c, t in totals]
    asked = cases.where("case_id IS NOT NULL").select(F.col("case_id").cast("long").alias("case_id"), F.explode(words(F.col("text"))).alias("term"))
    asked = asked.groupBy("case_id", "term").agg(F.count(F.lit(1)).alias("n"))
    found = chunk_frequencies(postings, chunkings).join(asked.select("term").distinct(), "term", "left_semi")
    idf = [F.ln(1 + (F.lit(float(c)) - F.col(f"n{i}") + 0.5) / (F.col(f"n{i}") + 0.5)) for i, (c, _) in enumerate(totals)]
    none = F.array_repeat(F.lit(0.0), len(chunkings))
    asked = cut_lineage(asked.join(found.select("term", F.array(*idf).alias("idf")), "term", "left").withColumn("idf", F.coalesce("idf", none)))
    sizes = postings.agg(F.sum("n_tokens")).first()[0] or 0
    d_blocks = max(1, ceil(sizes / BLOCK_TERMS))
    c_blocks = max(1, ceil((asked.agg(F.count_distinct("case_id")).first()[0]) / BLOCK_CASES))

    def blocks(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int):
        return df.select(
            "*", F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        ).groupBy("d", "c")

    pairs = blocks(postings, "doc_id", "d", d_blocks, "c", c_blocks).cogroup(blocks(asked, "case_id", "c", c_blocks, "d", d_blocks))
    return cut_lineage(pairs.applyInArrow(
        lambda left, right: _score_all(left, right, chunkings, average, depth, k1, b),
        "chunking int, by_vector boolean, case_id long, doc_id long, chunk_no long, score double, vector_score double, candidates long",
    ))


def retrieved_chunks(scored: DataFrame, depth: int, most: int, constant: int = 60) -> DataFrame:
    """Rows (chunking, search_mode, case_id, rank, doc_id, chunk_no): what each search mode returns, ``most`` chunks per case.

    ``vector`` ranks by cosine, ``keyword_semantic`` takes the ``depth`` best by BM25 and ranks them by cosine, ``hybrid`` fuses the two
    rankings of that depth by reciprocal ranks.  Ties go to the smaller document and chunk, after re-ranking to the better BM25 score.
    """
    key = ["chunking", "case_id"]
    place = ["doc_id", "chunk_no"]
    order = Window.partitionBy(*key, "by_vector").orderBy(F.desc("score"), *place)
    best = cut_lineage(scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth))

    def top(rows: DataFrame, mode: str, *by: Column) -> DataFrame:
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*by, *place)))
        return ranked.where(F.col("rank") <= most).select(*key, F.lit(mode).alias("search_mode"), "rank", *place)

    fused = best.groupBy(*key, *place).agg(F.round(F.sum(1.0 / (F.lit(constant) + F.col("rank"))), 9).alias("fused"))
    return (
        top(best.where("by_vector"), "vector", F.desc("score"))
        .unionByName(top(best.where("NOT by_vector"), "keyword_semantic", F.desc("vector_score"), F.desc("score")))
        .unionByName(top(fused, "hybrid", F.desc("fused")))
    )


def rag_runs(docs: DataFrame, cases: DataFrame, axes: Mapping[str, Sequence], depth: int = 20) -> DataFrame:
    """One measured row per configuration and case (every configuration runs over every case).

    ``axes``: chunk_size, overlap, search_mode, top_k.  ``hit`` is 1 if a retrieved chunk holds the whole text of the case
    (its tokens in a row), ``reciprocal_rank`` that of the first such chunk, ``coverage`` the share of the case's different words that the
    retrieved chunks hold, ``context_tokens`` their tokens, ``chunks_scored`` how many chunks the search had to score.  Cases without
    words, or for which nothing is found, get zeros.  Document and case ids are unique.
    """
    chunkings = [(s, o) for s in axes["chunk_size"] for o in axes["overlap"]]
    most = max(axes["top_k"])
    cases = cases.where("case_id IS NOT NULL").select(F.col("case_id").cast("long").alias("case_id"), "text")
    scored = scored_chunks(docs, cases, chunkings, max(depth, most))
    found = cut_lineage(retrieved_chunks(scored, max(depth, most), most))
    grid = F.array(*[F.struct(F.lit(i).alias("chunking"), F.lit(s).alias("size"), F.lit(s - o).alias("step")) for i, (s, o) in enumerate(chunkings)])
    # a document is cut into tokens once for all of its retrieved chunks, and a chunk into words once for all cases that got it
    places = cut_lineage(found.groupBy("doc_id").agg(F.collect_set(F.struct("chunking", "chunk_no")).alias("places")))
    if (places.agg(F.sum(F.size("places"))).first()[0] or 0) <= BROADCAST_ROWS:
        places = F.broadcast(places)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(places, "doc_id").repartition("doc_id")
    tokens = texts.select("doc_id", "places", F.explode(F.array(text_tokens(F.col("text")))).alias("_t"))

    def cut(place: Column) -> Column:
        shape = F.element_at(grid, place["chunking"] + 1)
        held = F.slice("_t", (place["chunk_no"] * shape["step"] + 1).cast("int"), shape["size"])
        return F.struct(place["chunking"].alias("chunking"), place["chunk_no"].alias("chunk_no"), held.alias("tokens"))

    piece = tokens.select("doc_id", F.inline(F.transform("places", cut)))
    piece = piece.select("chunking", "doc_id", "chunk_no", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("chunk"))
    piece = piece.withColumn("words", words(F.col("chunk")))
    asked = cases.select("case_id", F.array_join(text_tokens(F.col("text")), " ").alias("passage"), F.array_distinct(words(F.col("text"))).alias("terms"))
    judged = found.join(piece, ["chunking", "doc_id", "chunk_no"]).join(asked, "case_id")
    judged = judged.select(
        "chunking", "search_mode", "case_id", "rank", "n", F.array_intersect("terms", "words").alias("held"),
        F.when((F.col("passage") != "") & F.contains("chunk", "passage"), F.col("rank")).alias("hit_rank"),
    )
    per_k = judged.withColumn("top_k", F.explode(F.array(*[F.lit(k) for k in axes["top_k"]]))).where("rank <= top_k")
    per_k = per_k.groupBy("chunking", "search_mode", "top_k", "case_id").agg(
        F.min("hit_rank").alias("hit_rank"), F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"), F.sum("n").alias("context_tokens")
    )
    sums = scored.groupBy("chunking", "case_id").agg(
        F.sum(F.when(F.col("by_vector"), F.col("candidates"))).alias("by_vector"), F.sum(F.when(~F.col("by_vector"), F.col("candidates"))).alias("by_keyword")
    )
    numbered = F.transform(grid_array(axes), lambda c: c)
    combos = asked.select("case_id", F.size("terms").alias("n_terms"), F.inline(numbered))
    number = F.array_position(F.array(*[F.lit(f"{s}/{o}") for s, o in chunkings]), F.concat_ws("/", F.col("chunk_size").cast("string"), F.col("overlap").cast("string")))
    combos = combos.withColumn("chunking", (number - 1).cast("int"))
    rows = combos.join(per_k, ["chunking", "search_mode", "top_k", "case_id"], "left").join(sums, ["chunking", "case_id"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    work = F.when(F.col("search_mode") == "vector", zero(F.col("by_vector"))).when(F.col("search_mode") == "keyword_semantic", zero(F.col("by_keyword")))
    return rows.select(
        "combo_no", *axes, "case_id",
        F.col("hit_rank").isNotNull().cast("double").alias("hit"),
        F.when(F.col("n_terms") > 0, zero(F.col("held")) / F.col("n_terms")).otherwise(0.0).alias("coverage"),
        zero(1.0 / F.col("hit_rank")).cast("double").alias("reciprocal_rank"),
        zero(F.col("context_tokens")).cast("long").alias("context_tokens"),
        work.otherwise(zero(F.col("by_vector")) + zero(F.col("by_keyword"))).cast("long").alias("chunks_scored"),
    )


def rag_scores(runs: DataFrame, keys: Sequence[str], weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Per configuration: mean scores (4 places), mean context tokens and scored chunks, cost of the context, composite quality."""
    out = runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cases"), *[F.round(F.avg(m), 4).alias(m) for m in weights],
        F.round(F.avg("context_tokens"), 1).alias("avg_context_tokens"), F.round(F.avg("chunks_scored"), 1).alias("avg_chunks_scored"),
        cost(F.avg("context_tokens"), F.lit(0.0)).alias("estimated_cost_per_request"),
    )
    total = F.lit(0.0)
    for m, w in weights.items():
        total = total + F.col(m) * F.lit(w)
    return out.withColumn("composite_quality", F.round(total, 4))
