"""Subject areas of documents from latent Dirichlet topics.

Method: a distributed latent Dirichlet model is fitted for each language group over the distinct texts of all documents; its topics
are mapped to subjects through their top terms, as inspected; and a document gets the subjects whose topics together make up
enough of its topic proportions, which are inferred for every document under the fitted topics. Topics that hold next to nothing
of the corpus and topics without a subject that mix the terms of others, fragments of a few texts, are left out of that inference,
with the terms that are mostly theirs. A subject needs at least two different terms in the document, so that a figure of speech or a stray word doesn't count.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.session import discard, scratch_path

#: The inspection: top terms of topics fitted without labels (30 topics a language, sf0.1), put to the subject whose description
#: they fit. No label was looked at. They name the topics of every later fit.
INSPECTED: dict[str, dict[str, str]] = {
    "en": {
        "seismic": "fault fissures aftershock geologists anchoring ground",
        "weather": "froze drowned soaked reservoir sheeting washed",
        "fire": "flames embers firebreak scorched soot gutted",
        "shipping": "anchorage reefer congestion rerouted empties discharged",
        "labour": "employer voted rosters inflation unlawful strikes",
        "trade_law": "provenance judicial freezes consignments declarations appeal",
        "finance": "coupon liquidity analysts repayment payables refinanced",
        "production": "solder spindles throughput requalification scrapped voids",
        "cyber": "mailboxes corrupted outsider restored error exposed",
        "health": "pharmacies microbial saline kitchen assay procedures",
    },
    "de": {
        "seismic": "erdstoss bruchzone geologen messnetz nachbeben tsunamiwarnung",
        "weather": "niedrigwasser kältefront orkan dauerregen hochwasser unterspülte",
        "fire": "staubexplosion feuerwehr glut grossbrand russwolke qualm",
        "shipping": "frachtführer reede containerzug binnenschleuse liegeplatz kühlcontainer",
        "labour": "betriebsrat gewerkschaft lohnangebot dienstpläne ausstand warnstreik",
        "trade_law": "strafzoll herkunftsnachweis ausfuhrgenehmigung finanzgericht lieferkettengesetz embargo",
        "finance": "verbindlichkeiten insolvenzanmeldung kreditlinie bonität quartalsgewinn kupferpreis",
        "production": "pilotserie toleranz ausbeute gusswerkzeug ersatzspindeln substrate",
        "cyber": "bestellportal erpressungstrojaner zugangsdaten firewall zertifikat verschlüsselte",
        "health": "apotheken impfstofflieferung ausbruch keimtest quarantäne klinik",
    },
    "es": {
        "seismic": "cráter réplica falla sismógrafos maremoto agrietó",
        "weather": "tormenta granizo heló sequía crecida inundó",
        "fire": "llamas hectáreas humareda explosión incendio resina",
        "shipping": "naviera muelle fondeado contenedores esclusa buque",
        "labour": "comité huelga salarial horarios votó estibadores",
        "trade_law": "embargo arancel procedencia aduanero tribunal exportación",
        "finance": "previsiones crediticia calificación acreedores concurso trimestral",
        "production": "chatarra molde sustratos tolerancia husillos recalificación",
        "cyber": "certificado cifró carpetas contraseñas parche rescate",
        "health": "microbiano vacunas brote cuarentena hospital farmacias",
    },
    "ja": {
        "seismic": "津波 震が 亀裂 観測 揺れ",
        "weather": "寒波 大雨 氾濫 河川 濃霧 浸水",
        "fire": "延焼 燃え 焼い え移 焼を",
        "shipping": "貨物 沖で 列車 降ろ 着岸",
        "labour": "勤務 務表 安全 拒否 条件",
        "trade_law": "控訴 訴審 税率 義務 証出",
        "finance": "予想 支払 上回 払い 賄え",
        "production": "公差 再認 認定 合格 廃棄 金型",
        "cyber": "認証 暗号 漏ら 共有 情報",
        "health": "検査 細菌 手術 感染 汚染",
    },
}
LANGUAGES = tuple(INSPECTED)
#: Frequent function words that tell the languages apart.
FUNCTION_WORDS = {"en": "the and was for with from", "de": "der die das und den wird", "es": "el la los del las por"}
#: Terms without a subject, left out of the models. No cut by frequency: a text that is copied often makes its own terms frequent.
STOP_WORDS = {
    "en": "the and was were for with from that this its while under after over before without according later same meanwhile are has have had been but not",
    "de": "der die das den dem des und auf eine einen einer einem ein wurde wurden wird ist sind war mit von für bei nach aus nicht auch sich",
    "es": "del las los por que con una uno para fue fueron más sin sus como este esta entre",
    "ja": "では した った れた され です ます から まで して いる いた",
}

_WORD = re.compile(r"[^\W\d_]+")
_CJK = re.compile(r"[぀-ヿ一-鿿]")
_TAG = re.compile(r"<[^<>]+>")
_PAIR = re.compile(r'"[^"{}]*"\s*:\s*(?:null|true|false|[-+\d.eE]+)')
_SPEAKER = re.compile(r"^\s*\[\d{1,2}:\d{2}\] *[\w-]+:", re.MULTILINE)
_HIDDEN = re.compile(r"[­​-‏‪-‮⁠﻿]")
_FUNCTION = {w: g for g, words in FUNCTION_WORDS.items() for w in words.split()}


@dataclass(frozen=True)
class Settings:
    """topics, vocabulary (most terms, the most frequent first), least_documents (terms in fewer documents of a language, copies
    counted, are left out unless they name a subject; in a language with fewer documents, terms that aren't in all), and passes
    of each language's model: how often its steps, `iterations` in number, sample each text, on average and whatever the number of
    texts. share: the least part of a document's topic proportions, midway between an eighth, a mention in passing, and a
    fifth. attempts: fits, each with half as many topics more, while a subject's terms are there but it has no topic of
    its own, or topics of two subjects hold `mixed` of all term weight; the best one counts.
    fragment: the part of all term weight below which a topic that isn't its subject's greatest is left out. density: prior
    of a document's topics."""

    topics: int = 20
    vocabulary: int = 20_000
    least_documents: int = 4
    iterations: int = 30
    passes: float = 6.0
    share: float = 0.1625
    attempts: int = 3
    mixed: float = 0.02
    fragment: float = 0.002
    density: float = 0.05
    seed: int = 11


def normalized(text: str) -> str:
    """Composed, case-folded text without markup, JSON pairs that aren't text, invisible characters and the names before the lines of a chat."""
    return unicodedata.normalize("NFKC", _SPEAKER.sub(" ", _PAIR.sub(" ", _TAG.sub(" ", _HIDDEN.sub("", text)))).casefold())


def terms(text: str) -> list[str]:
    """Words of three letters or more; pairs of neighbouring characters where the script has no spaces."""
    out: list[str] = []
    for word in _WORD.findall(text):
        if _CJK.search(word):
            out += [word[i : i + 2] for i in range(len(word) - 1)]
        elif len(word) > 2:
            out.append(word)
    return out


def language_group(text: str) -> str:
    """Group of normalized text by its characters and function words; wrong or missing labels don't matter."""
    if len(_CJK.findall(text)) > 0.15 * len(text):
        return "ja"
    votes = dict.fromkeys(FUNCTION_WORDS, 0)
    for word in _WORD.findall(text):
        if word in _FUNCTION:
            votes[_FUNCTION[word]] += 1
    return max(votes, key=votes.__getitem__)


def _prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, group, terms) of each document with terms; terms joined by blanks, as lists take many times the memory in Python."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, joined = [], []
            for text in batch.column("text"):
                clean = normalized(text.as_py())
                groups.append(language_group(clean))
                joined.append(" ".join(terms(clean)))
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(groups, pa.string()), pa.array(joined, pa.string())], ["doc_id", "group", "terms"])
            yield out.filter(pa.array([bool(j) for j in joined], pa.bool_()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.where("length(text) > 0").select("doc_id", "text").mapInArrow(prepare, f"doc_id {kind}, group string, terms string")


def group_vocabulary(rows: DataFrame, naming: dict[str, list[str]], group: str, settings: Settings) -> list[str]:
    """Terms of the group's model, those that name subjects and the most frequent first. rows: (terms, copies).

    A document's copies count, so that no term is lost because only copies of one text have it.
    """
    names = sorted({w for words in naming.values() for w in words})
    least = min(settings.least_documents, rows.agg(F.sum("copies")).first()[0])
    found = rows.select("copies", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.sum("copies").alias("documents"))
    kept = found.where(F.col("term").isin(names) | (F.col("documents") >= least) & ~F.col("term").isin(STOP_WORDS[group].split()))
    return [r.term for r in kept.orderBy(F.col("term").isin(names).desc(), F.col("documents").desc(), "term").limit(settings.vocabulary).collect()]


def naming_terms(subjects: Sequence[tuple[str, str]], group: str) -> dict[str, list[str]]:
    """Terms that name each of the subjects (subject, description) in a language: the inspected ones; for a subject that hasn't
    been inspected those of its description."""
    known = INSPECTED[group]
    return {s: terms(normalized(known.get(s) or description or "")) for s, description in subjects}


def topic_subjects(weights: np.ndarray, names: Sequence[Sequence[int]]) -> tuple[np.ndarray, float]:
    """Number of each topic's subject (-1: none), and how bad the topics are: the number of subjects that have terms but no topic,
    plus the part of all weight in topics that a second subject names half as strongly.

    weights: (terms, topics); names: places of the naming terms of each subject. A topic belongs to the subject whose terms
    have the greatest mass in it, counted by how much of each term is in it.
    """
    within = weights / weights.sum(axis=0, keepdims=True)
    of_term = weights / weights.sum(axis=1, keepdims=True)
    mass = np.stack([(within[list(at)] * of_term[list(at)]).sum(axis=0) if at else np.zeros(weights.shape[1]) for at in names], axis=1)
    subject_of = np.where(mass.max(axis=1) >= 0.002, mass.argmax(axis=1), -1)
    first_two = np.sort(np.hstack([mass, np.zeros((len(mass), 1))]), axis=1)[:, -2:]
    mixed = (subject_of >= 0) & (first_two[:, 0] > 0.5 * first_two[:, 1])
    homeless = sum(1 for s, at in enumerate(names) if at and s not in subject_of)
    return subject_of, homeless + float(weights[:, mixed].sum() / weights.sum())


@dataclass(frozen=True)
class TopicModel:
    """A language group's topics: place of each term, weights (terms, topics; every topic's sum is 1) and each topic's subject."""

    place: dict[str, int]
    weights: np.ndarray
    subject_of: np.ndarray


def kept_topics(weights: np.ndarray, subject_of: np.ndarray, fragment: float) -> np.ndarray:
    """Numbers of the topics that hold at least `fragment` of all weight, or the most of their subject; of those without a subject
    only if at least half of their weight is in terms that no subject's topic has more of."""
    held = weights.sum(axis=0) / weights.sum()
    greatest = {int(np.where(subject_of == s, held, -1).argmax()) for s in set(subject_of.tolist()) - {-1}}
    taken = subject_of[weights.argmax(axis=1)] >= 0
    foreign = weights[taken].sum(axis=0) / weights.sum(axis=0)
    return np.array([t for t in range(len(held)) if t in greatest or (held[t] >= fragment and (subject_of[t] >= 0 or foreign[t] <= 0.5))], dtype=np.int64)


def proportions(counts: Sequence[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, density: float, most_steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(documents, topics): mean topic proportions by variational inference under fixed topics, all documents side by side; and the
    number of different terms that are each topic's by half or more.

    counts: places and counts of each document's terms, none of them empty. Steps end when no document moves by 0.002.
    """
    weights = weights.astype(np.float32)
    at, n = np.concatenate([p for p, _ in counts]), np.concatenate([c for _, c in counts]).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p, _ in counts])[:-1]])
    of = np.repeat(np.arange(len(counts)), [len(p) for p, _ in counts])
    beta = weights[at]
    mean = np.full((len(counts), weights.shape[1]), 1.0 / weights.shape[1], dtype=np.float32)
    total = np.add.reduceat(n, starts)[:, None]
    gamma = np.float32(density) + mean * total
    for _ in range(most_steps):
        theta = np.exp(digamma(gamma))
        ratio = n / (np.einsum("ij,ij->i", theta[of], beta) + np.float32(1e-30))
        gamma = np.float32(density) + theta * np.add.reduceat(beta * ratio[:, None], starts, axis=0)
        before, mean = mean, gamma / gamma.sum(axis=1, keepdims=True)
        if np.abs(mean - before).max() < 2e-3:
            break
    owned = theta[of] * beta
    owned = owned >= 0.5 * owned.sum(axis=1, keepdims=True) + np.float32(1e-30)
    return mean, np.add.reduceat(owned.astype(np.int64), starts, axis=0)


def digamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers: the recurrence up to six, then the asymptotic series."""
    shift = np.zeros_like(x)
    x = x.copy()
    for _ in range(6):
        low = x < 6
        shift -= np.where(low, 1 / x, 0)
        x += low
    f = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f / 252))


def _topics(vectors: DataFrame, topics: int, settings: Settings, seed: int) -> np.ndarray:
    """Weights (terms, topics) by online variational Bayes. The steps draw with replacement: exp(-passes) of the rows are never drawn."""
    model = LDA(
        k=topics, maxIter=settings.iterations, optimizer="online", subsamplingRate=min(1.0, settings.passes / settings.iterations), learningOffset=16, learningDecay=0.6, docConcentration=[settings.density] * topics, topicConcentration=0.02, seed=seed,
    ).fit(vectors)
    return model.topicsMatrix().toArray()


def _fit_group(documents: DataFrame, group: str, subjects: Sequence[tuple[str, str]], settings: Settings) -> TopicModel | None:
    # each distinct text once: one copied often would else draw topics to itself; in a fixed order, so that the samples of a
    # fit don't hang on which shuffle block came first
    own = documents.where(F.col("group") == group).groupBy("terms").agg(F.count("*").alias("copies")).sortWithinPartitions("terms")
    rows = own.select(F.split("terms", " ").alias("terms"), "copies").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if rows.isEmpty():
            return None
        naming = naming_terms(subjects, group)
        words = group_vocabulary(rows, naming, group, settings)
        at = {w: i for i, w in enumerate(words)}
        names = [[at[w] for w in naming[s] if w in at] for s, _ in subjects]
        if not any(names):
            return None
        vocabulary = CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="features")
        vectors = vocabulary.transform(rows.select("terms")).select("features").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            best = None
            for attempt in range(settings.attempts):
                weights = _topics(vectors, settings.topics * (2 + attempt) // 2, settings, settings.seed + attempt)
                subject_of, fault = topic_subjects(weights, names)
                if best is None or fault < best[0]:
                    kept = kept_topics(weights, subject_of, settings.fragment)
                    own = {w: i for w, i in at.items() if weights[i, kept].sum() >= 0.5 * weights[i].sum()}
                    best = (fault, TopicModel(own, weights[:, kept] / weights[:, kept].sum(axis=0), subject_of[kept]))
                if fault < settings.mixed:
                    break
            return best[1]
        finally:
            vectors.unpersist()
    finally:
        rows.unpersist()


#: terms of the documents whose proportions are inferred side by side
BLOCK_TERMS = 50_000


def assign_subjects(documents: DataFrame, models: dict[str, TopicModel], names: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """(doc_id, subject, share) of each document (doc_id, group, terms) by its topic proportions; none without a term of its model."""
    known = documents.sparkSession.sparkContext.broadcast(models)  # bounded by the vocabulary
    kind = documents.schema["doc_id"].dataType.simpleString()

    def infer(ids: list, counts: list, model: TopicModel) -> pd.DataFrame:
        mean, owned = proportions(counts, model.weights, settings.density)
        by_subject, support = (np.stack([x[:, model.subject_of == s].sum(axis=1) for s in range(len(names))], axis=1) for x in (mean, owned))
        doc, subject = np.nonzero((by_subject >= settings.share) & (support >= 2))
        return pd.DataFrame({"doc_id": [ids[d] for d in doc], "subject": [names[s] for s in subject], "share": by_subject[doc, subject]})

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for group, part in pdf.groupby("group"):
                model, ids, counts, held = known.value.get(group), [], [], 0
                if model is None:
                    continue
                for doc, text in zip(part["doc_id"], part["terms"], strict=True):
                    at = [model.place[w] for w in text.split(" ") if w in model.place]
                    if at:
                        ids.append(doc)
                        counts.append(np.unique(at, return_counts=True))
                        held += len(counts[-1][0])
                    if held >= BLOCK_TERMS:
                        yield infer(ids, counts, model)
                        ids, counts, held = [], [], 0
                if ids:
                    yield infer(ids, counts, model)

    return documents.select("doc_id", "group", "terms").mapInPandas(assign, f"doc_id {kind}, subject string, share double")


def document_subjects(docs: DataFrame, subjects: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, subject, share) of each document with each subject that makes up at least settings.share of it.

    docs: doc_id, text; subjects: subject, description - the closed list of subject areas, which is read into the driver. The models
    are fitted and applied at once; the result is a table in the shared folder. Null, empty and blank texts, and texts without a
    term of the models, have no subject; repeated doc_ids are reported each; empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    named = [(r.subject, r.description) for r in subjects.where("subject is not null").groupBy("subject").agg(F.min("description").alias("description")).orderBy("subject").collect()]
    prepared, result = scratch_path(spark, "terms"), scratch_path(spark, "subjects")
    kind = docs.schema["doc_id"].dataType.simpleString()
    _prepared(docs.select("doc_id", "text")).write.partitionBy("group").parquet(prepared)
    documents = spark.read.schema(f"doc_id {kind}, terms string, group string").parquet(prepared)
    try:
        with ThreadPoolExecutor(len(LANGUAGES)) as pool:
            models = dict(zip(LANGUAGES, pool.map(lambda g: _fit_group(documents, g, named, settings), LANGUAGES), strict=True))
        found = assign_subjects(documents, {g: m for g, m in models.items() if m is not None}, [n for n, _ in named], settings)
        found.write.parquet(result)
    finally:
        discard(spark, prepared)
    return spark.read.schema(found.schema).parquet(result)
