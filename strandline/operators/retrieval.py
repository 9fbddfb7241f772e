"""Evidence retrieval: parsing, chunking, lexical and vector scores, fusion, and selection within a budget."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: fixed values: weights of the parts of the final score
WEIGHTS = {"vector": 0.55, "bm25": 0.30, "recency": 0.10, "reliability": 0.05}
K1, B = 1.2, 0.75


def parsed_text(html: Column) -> Column:
    """Text without tags, scripts and comments, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^<>]+>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


#: scripts without spaces: each character is a word of its own
_UNSPACED = "\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
_ATOM = re.compile(rf"([{_UNSPACED}]|[^\s{_UNSPACED}]+)(\s*)")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")


def atoms(text: str) -> list[tuple[str, int]]:
    """Words, and characters where the script has no spaces, each with what follows it (a blank or nothing) and an estimate of its
    tokens under a byte-level vocabulary: one for up to six plain letters, two for each five of longer words; one for each digit or
    sign, and for one and a half bytes of other characters."""
    out = []
    for m in _ATOM.finditer(text):
        word = m.group(1)
        letters = sum(1 for c in word if "a" <= c <= "z" or "A" <= c <= "Z")
        others = sum(len(c.encode("utf-8", "surrogatepass")) for c in word if c > "\x7f")
        signs = sum(1 for c in word if c <= "\x7f") - letters
        out.append((word + (" " if m.group(2) else ""), max(1, (min(letters, 1) if letters <= 6 else -(-letters * 2 // 5)) + signs + -(-others * 2 // 3))))
    return out


def chunks(docs: DataFrame, most: int = 480, overlap: int = 50) -> DataFrame:
    """(doc_id, chunk_no, chunk_id, content, n_tokens, content_hash) of whole texts.

    Sentences are gathered up to `most` tokens, as `atoms` estimates them, and never cut, unless one alone is longer: that one is
    cut between words, or between characters where the script has no spaces. A chunk starts with the last sentences of the
    one before, up to `overlap` tokens. The title, if there is a column of that name, goes in front and counts. Null and blank
    texts have no chunks.
    """
    has_title = "title" in docs.columns

    def runs(text: str, room: int) -> list[list[tuple[str, int]]]:
        parts = []
        for sentence in _SENTENCE_END.split(text):
            part, size = [], 0
            for atom in atoms(sentence):
                if part and size + atom[1] > room:
                    parts.append(part)
                    part, size = [], 0
                part.append(atom)
                size += atom[1]
            if part:
                parts.append(part)
        return parts

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, text, title in zip(pdf["doc_id"], pdf["text"], pdf["title"], strict=True):
                head = f"{title}\n" if title else ""
                own = min(sum(n for _, n in atoms(head)), most // 2)
                room = most - own
                held: list[tuple[str, int]] = []  # sentences as text and tokens
                size, number, fresh = 0, 0, False
                for part in [*runs(text, room), None]:
                    tokens_ = sum(n for _, n in part) if part else 0
                    if part is None or size + tokens_ > room:
                        if fresh:
                            out.append((doc, number, head + " ".join(s.strip() for s, _ in held), size + own))
                            number += 1
                        kept: list[tuple[str, int]] = []
                        left = min(overlap, room - tokens_)
                        for s in reversed(held):
                            if s[1] > left:
                                break
                            kept.insert(0, s)
                            left -= s[1]
                        held, size, fresh = kept, sum(n for _, n in kept), False
                    if part:
                        held.append(("".join(w for w, _ in part), tokens_))
                        size += tokens_
                        fresh = True
            yield pd.DataFrame(out, columns=["doc_id", "chunk_no", "content", "n_tokens"])

    texts = docs.where("text is not null").select("doc_id", "text", (F.col("title") if has_title else F.lit(None).cast("string")).alias("title"))
    rows = texts.mapInPandas(cut, "doc_id bigint, chunk_no int, content string, n_tokens int")
    chunk_id = F.format_string("%d::v1::chunk-%04d", "doc_id", "chunk_no")
    return rows.select("doc_id", "chunk_no", chunk_id.alias("chunk_id"), "content", "n_tokens", F.sha2("content", 256).alias("content_hash"))


def unembedded(chunk_rows: DataFrame, done: DataFrame, model: str) -> DataFrame:
    """Chunks that this model version hasn't embedded yet. done: chunk_id, model_version."""
    return chunk_rows.join(done.where(F.col("model_version") == model).select("chunk_id").distinct(), "chunk_id", "left_anti")


BLOCK = 2048


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """Rows (id, vector) packed into rows of up to BLOCK ids and one run of doubles."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), BLOCK):
                part = pdf.iloc[at : at + BLOCK]
                yield pd.DataFrame({f"{name}_ids": [part["id"].to_numpy()], f"{name}_vectors": [np.concatenate([np.asarray(v, dtype=float) for v in part["vector"]])]})

    return rows.where("id is not null and vector is not null and size(vector) > 0").mapInPandas(pack, f"{name}_ids array<bigint>, {name}_vectors array<double>")


def _unit(ids: np.ndarray, flat: np.ndarray) -> np.ndarray:
    m = np.asarray(flat, dtype=float).reshape(len(ids), -1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _best_of_blocks(met: DataFrame, k: int | None) -> DataFrame:
    """(query_id, item_id, similarity) of rows that hold a block of queries and a block of items: one matrix product each."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for q_ids, q, i_ids, i in zip(pdf["q_ids"], pdf["q_vectors"], pdf["i_ids"], pdf["i_vectors"], strict=True):
                order = np.argsort(i_ids, kind="stable")
                likeness = np.round(_unit(q_ids, q) @ _unit(i_ids, i)[order].T, 6) + 0.0
                top = np.argsort(-likeness, axis=1, kind="stable")[:, :k]
                yield pd.DataFrame({"query_id": np.repeat(q_ids, top.shape[1]), "item_id": np.asarray(i_ids)[order][top].ravel(), "similarity": np.take_along_axis(likeness, top, 1).ravel()})

    return met.select("q_ids", "q_vectors", "i_ids", "i_vectors").mapInPandas(best, "query_id bigint, item_id bigint, similarity double")


def similarities(queries: DataFrame, items: DataFrame, k: int | None = None) -> DataFrame:
    """(query_id, item_id, similarity): the cosine of each query with every item, or with the k best of each block of items.

    queries: query_id, vector - a stated set; items: item_id, vector. Both are packed into blocks, and every block of queries meets
    every block of items in one matrix product. Rows without a vector are left out, vectors of zeros are similar to nothing
    (0); all vectors have one length.
    """
    asked = _blocks(queries.select(F.col("query_id").cast("bigint").alias("id"), "vector"), "q")
    stock = _blocks(items.select(F.col("item_id").cast("bigint").alias("id"), "vector"), "i")
    return _best_of_blocks(stock.crossJoin(asked), k)


def fit_cells(items: DataFrame, k: int, cells: int = 64, recall: float = 0.95, sample_rows: int = 20_000, rounds: int = 12, seed: int = 1) -> tuple[np.ndarray, int]:
    """Unit centres (cells, length) of an inverted file, by k-means over at most sample_rows items, those with the least hash of their
    id; and how many cells a query must probe so that, within the sample, that part of its k nearest is found. The sample is
    all that is read into the driver."""
    known = items.where("item_id is not null and vector is not null and size(vector) > 0")
    rows = known.select("vector", F.xxhash64(F.lit(seed), "item_id").alias("_h")).orderBy("_h").limit(sample_rows).collect()
    if not rows:
        return np.zeros((0, 0)), 0
    m = np.array([r.vector for r in rows], dtype=float)
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    centres = m[np.random.default_rng(seed).choice(len(m), min(cells, len(m)), replace=False)]
    for _ in range(rounds):
        near = (m @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own := m[near == c]).size:
                centres[c] = own.mean(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    asked = m[:200]
    likeness = asked @ m.T
    likeness[np.arange(len(asked)), np.arange(len(asked))] = -2  # not itself
    nearest = np.argsort(-likeness, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1), axis=1)  # of each cell for each query
    needed = np.sort(np.take_along_axis(place, (m @ centres.T).argmax(axis=1)[nearest], axis=1).ravel()) + 1
    return centres, int(needed[min(len(needed) - 1, int(recall * len(needed)))])


def indexed(rows: DataFrame, name: str, centres: np.ndarray, probes: int = 1) -> DataFrame:
    """Rows (id, vector) in blocks by cell: cell, ids and one run of doubles. A row is in the `probes` cells nearest to it; a cell with
    many rows has many blocks."""
    known = rows.sparkSession.sparkContext.broadcast(centres)  # bounded: cells times the length of a vector

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            m = np.stack([np.asarray(v, dtype=float) for v in pdf["vector"]])
            near = np.argsort(-(m @ known.value.T), axis=1, kind="stable")[:, :probes]
            ids = pdf["id"].to_numpy()
            for cell in np.unique(near):
                own = np.flatnonzero((near == cell).any(axis=1))
                for at in range(0, len(own), BLOCK):
                    part = own[at : at + BLOCK]
                    yield pd.DataFrame({"cell": [int(cell)], f"{name}_ids": [ids[part]], f"{name}_vectors": [m[part].ravel()]})

    return rows.where("id is not null and vector is not null and size(vector) > 0").mapInPandas(place, f"cell int, {name}_ids array<bigint>, {name}_vectors array<double>")


def knn_indexed(queries: DataFrame, items: DataFrame, k: int, cells: int = 64, recall: float = 0.95, sample_rows: int = 20_000) -> DataFrame:
    """As knn, by an inverted file: each query is held against the items of the nearest cells, as many as fit_cells finds necessary
    for the recall. Every item is in the index; knn is the exact way."""
    centres, probes = fit_cells(items, k, cells, recall, sample_rows)
    if not len(centres):
        return knn(queries, items, k)
    asked = indexed(queries.select(F.col("query_id").cast("bigint").alias("id"), "vector"), "q", centres, probes)
    stock = indexed(items.select(F.col("item_id").cast("bigint").alias("id"), "vector"), "i", centres)
    return _ranked(_best_of_blocks(stock.join(asked, "cell"), k), k)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "item_id")
    return scored.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def knn(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(query_id, item_id, similarity, place): the k items of the greatest cosine to each query, exactly; item_id breaks ties.

    As similarities, of which each block keeps k items a query; the survivors are ranked.
    """
    return _ranked(similarities(queries, items, k), k)


def bm25(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of each document with a term of the query. queries: query_id, query.

    Statistics are over all documents; texts without tokens count as documents of length 0. Only the postings of query terms
    are kept, so the corpus is read once for them and once for the lengths.
    """
    words = docs.where("doc_id is not null").select("doc_id", F.coalesce(tokens(F.col("text")), F.array().cast("array<string>")).alias("_t"))
    overall = words.agg(F.count("*").alias("_n"), F.avg(F.size("_t")).alias("_mean"))
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    lists = words.select("doc_id", F.size("_t").alias("_len"), F.explode("_t").alias("term")).join(asked.select("term").distinct(), "term", "left_semi")
    counted = lists.groupBy("term", "doc_id", "_len").agg(F.count("*").alias("_tf"))
    frequency = counted.groupBy("term").agg(F.count("*").alias("_df"))
    met = counted.join(frequency, "term").join(asked, "term").join(overall, F.lit(True))
    idf = F.log1p((F.col("_n") - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    part = idf * F.col("_tf") * (K1 + 1) / (F.col("_tf") + K1 * (1 - B + B * F.col("_len") / F.col("_mean")))
    return met.groupBy("query_id", "doc_id").agg(F.sum(part).alias("score"))


def candidates(items: DataFrame, queries: DataFrame, vector: DataFrame, lexical: DataFrame) -> DataFrame:
    """Each item for each query, with vector and bm25 where they are known: no item is lost for want of a query term or a vector.

    items: item_id and further columns; queries: query_id; vector: query_id, item_id, vector; lexical: query_id, item_id, bm25.
    """
    both = items.crossJoin(queries.select("query_id").distinct())
    return both.join(vector, ["query_id", "item_id"], "left").join(lexical, ["query_id", "item_id"], "left")


def fused(scores: DataFrame) -> DataFrame:
    """scores (query_id, item_id, vector, bm25, recency, reliability) with final_score: vector and bm25 scaled to 0..1 within the
    query (0 if all are equal), nulls count as 0. The ranges are an aggregate that is joined back, one row a query, so the
    candidates of a query need not meet in one task."""
    parts = ("vector", "bm25")
    filled = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in parts}
    ranges = scores.groupBy("query_id").agg(*[how(filled[c]).alias(f"_{name}_{c}") for c in parts for name, how in (("low", F.min), ("high", F.max))])
    scaled = {c: F.coalesce((filled[c] - F.col(f"_low_{c}")) / F.when(F.col(f"_high_{c}") > F.col(f"_low_{c}"), F.col(f"_high_{c}") - F.col(f"_low_{c}")), F.lit(0.0)) for c in parts}
    total = sum(WEIGHTS[c] * scaled[c] for c in parts) + WEIGHTS["recency"] * F.coalesce("recency", F.lit(0.0)) + WEIGHTS["reliability"] * F.coalesce("reliability", F.lit(0.0))
    return scores.join(ranges, "query_id").withColumn("final_score", total).select(*scores.columns, "final_score")


def best_per_document(ranked: DataFrame) -> DataFrame:
    """The best item of each document per query. ranked: query_id, doc_id, item_id, final_score."""
    w = Window.partitionBy("query_id", "doc_id").orderBy(F.col("final_score").desc(), "item_id")
    return ranked.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def within_budget(ranked: DataFrame, budget: int) -> DataFrame:
    """The items of each query in order of score whose tokens together stay within the budget; the first that doesn't fit ends
    the list. ranked: query_id, item_id, final_score, n_tokens; an item counts one token at least, so that more than the best
    `budget` items can't matter: only those are summed up."""
    w = Window.partitionBy("query_id").orderBy(F.col("final_score").desc(), "item_id")
    best = ranked.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= budget).drop("_n")
    used = F.sum(F.greatest(F.col("n_tokens"), F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return best.withColumn("used_tokens", used).where(F.col("used_tokens") <= budget)


def diverse(ranked: DataFrame, k: int, balance: float = 0.7) -> DataFrame:
    """Maximal marginal relevance: (query_id, item_id, place) of k items per query, each the best by balance * final_score minus
    (1 - balance) times its greatest similarity to those chosen. ranked: query_id, item_id, final_score, vector; candidates of a
    query, already limited to a top k, are gathered in one task."""
    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["final_score", "item_id"], ascending=[False, True])
        v = np.stack(pdf["vector"].to_numpy()).astype(float)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        score, alike, free, order = pdf["final_score"].to_numpy(), np.zeros(len(pdf)), np.ones(len(pdf), bool), []
        while free.any() and len(order) < k:
            at = int(np.where(free, balance * score - (1 - balance) * alike, -np.inf).argmax())
            order.append(at)
            free[at] = False
            alike = np.maximum(alike, v @ v[at])
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[order], "item_id": pdf["item_id"].iloc[order], "place": range(1, len(order) + 1)})

    return ranked.groupBy("query_id").applyInPandas(choose, "query_id bigint, item_id bigint, place int")


def citation_problems(claims: DataFrame, evidence: DataFrame, context: DataFrame) -> DataFrame:
    """(claim_id, evidence_id, problem) of claims (claim_id, evidence_ids): no_evidence, unknown, not_in_context, inactive.
    evidence: evidence_id, is_active; context: evidence_id of what the request was given."""
    cited = claims.select("claim_id", F.explode_outer("evidence_ids").alias("evidence_id"))
    known = cited.join(evidence.select("evidence_id", "is_active"), "evidence_id", "left").join(context.select("evidence_id").distinct().withColumn("_given", F.lit(True)), "evidence_id", "left")
    problem = F.when(F.col("evidence_id").isNull(), "no_evidence").when(F.col("is_active").isNull(), "unknown").when(F.col("_given").isNull(), "not_in_context").when(~F.col("is_active"), "inactive")
    return known.select("claim_id", "evidence_id", problem.alias("problem")).where("problem is not null")


def number_problems(claims: DataFrame, facts: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(claim_id, fact_id, problem) of claims (claim_id, fact_id, value): unknown - no such fact -, missing - a null on either side -,
    or mismatch - off by more than `tolerance` of the fact (fact_id, value)."""
    known = claims.join(facts.select("fact_id", F.col("value").alias("_fact"), F.lit(True).alias("_there")), "fact_id", "left")
    off = F.abs(F.col("value") - F.col("_fact")) > tolerance * F.greatest(F.lit(1.0), F.abs("_fact"))
    problem = F.when(F.col("_there").isNull(), "unknown").when(F.col("value").isNull() | F.col("_fact").isNull(), "missing").when(off, "mismatch")
    return known.select("claim_id", "fact_id", problem.alias("problem")).where("problem is not null")


def policy_problems(answers: DataFrame, tenant: str) -> DataFrame:
    """(answer_id, problem) of answers (answer_id, text, tenant_id): email or phone in the text, or other_tenant."""
    email, phone = F.col("text").rlike(r"[\w.+-]+@[\w-]+\.[\w.]+"), F.col("text").rlike(r"\+\d[\d ()-]{7,}\d")
    cases = F.array_compact(F.array(F.when(email, F.lit("email")), F.when(phone, F.lit("phone")), F.when(F.col("tenant_id") != tenant, F.lit("other_tenant"))))
    return answers.select("answer_id", F.explode(cases).alias("problem"))
