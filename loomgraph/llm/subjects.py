"""Subject areas of documents, by label propagation from hand-labelled seeds over a similarity graph.

Two documents are similar as far as they share terms, and labels pass along that similarity. Pairs of
documents are never built, as those of one subject are a square of its size: the graph is kept as
edges between documents and the terms they hold, and a round is two joins, from documents to terms and
back, which sums over all similar documents. An edge passes labels only when it is verified: its term
must be held by enough labelled documents, and of these belong to one subject, or few, far more often
than all do. A term once verified by ``ENOUGH_DOCS`` documents, or found to link documents of any
subject, is decided: words that every project uses are taken out of the graph for the later rounds.

Seeds are tried once, before the propagation: each by the edges to the other seeds, without its own
label. A label they support is trusted, and so are the labels of a document about which they are silent.
Trusted labels are clamped: a seed keeps them in every round and in the result, and may gain others. A
label is taken for an annotator's mistake where they speak for a subject that its document was not
given; one that is merely not among those they support takes part in the first round and then stands as
any other label does. A round labels all documents; the last is the one that changes no label. A document takes every subject that ``LEAST_SENTENCES`` of its sentences are
about in at least ``LEAST_TERMS`` different terms; one sentence is a passing mention, and one term alone
counts only in more sentences and where many documents have shown its subject.

Null and empty texts, and texts of fewer sentences, have no subject; texts without verified terms have
only what they are labelled. Repeated rows of one doc_id count once; the largest text counts. Labels
without a document, with null fields or with a subject outside the list are not used. Without labels
the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.sizing import broadcast_if_small, collect_bounded, one_row_each
from loomgraph.session import Scratch

#: A term's share in its main subject, in any subject it keeps, and in
#: those together; how often a share must exceed the subject's own.
LEAST_PURITY, LEAST_SHARE, LEAST_SUM, LEAST_LIFT = 0.4, 0.2, 0.7, 2.0
#: Labelled documents a term must occur in, among the seeds and in later rounds, and those that decide it for good.
SEED_DOCS, LEAST_DOCS, ENOUGH_DOCS = 2, 4, 50
#: Bound of the closed list of subjects.
MOST_SUBJECTS = 10_000
LEAST_SENTENCES, LEAST_TERMS, SURE = 2, 2, 0.8

_WRAP = r"(?<![.!?:;{}\n])\r?\n[ \t]*(?:#|//|>|\*)?[ \t]*(?=\p{Ll})(?!(?:def|func|const|return|class|import|for|if|type|var|let|package|select|from)\b)"
_END = r"(?<=[.!?;{}])\s+|[\r\n]+"


def terms(sentence: Column) -> Column:
    """Hashes of the distinct words of a sentence."""
    return F.array_distinct(F.transform(F.regexp_extract_all(sentence, F.lit(r"(\p{L}{3,})"), F.lit(1)), lambda w: F.xxhash64(w)))


def sentences(documents: DataFrame) -> DataFrame:
    """(doc_id, sents): per document the terms of every sentence that has any, one row a document; joined names are taken apart."""
    one = one_row_each(documents.select("doc_id", "text").filter(F.col("text").isNotNull()), "doc_id")
    apart = F.lower(F.regexp_replace(F.regexp_replace("text", _WRAP, " "), r"(\p{Ll})(\p{Lu})", "$1 $2"))
    return one.select("doc_id", F.filter(F.transform(F.split(apart, _END), terms), lambda x: F.size(x) > 0).alias("sents"))


def said(sents: DataFrame) -> DataFrame:
    """(doc_id, sent_no, term): the terms of every sentence, a row each."""
    return sents.select("doc_id", F.posexplode("sents").alias("sent_no", "words")).select("doc_id", "sent_no", F.explode("words").alias("term"))


def edges_of(sents: DataFrame) -> DataFrame:
    """(doc_id, term): every term a document holds, once."""
    return sents.select("doc_id", F.explode(F.array_distinct(F.flatten("sents"))).alias("term"))


def count_terms(edges: DataFrame, labels: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(term, subject, n, docs): labelled documents (doc_id, subject, n_subjects) of a subject that hold a term, and of any."""
    seen = edges.join(broadcast_if_small(labels), "doc_id").select("subject", "n_subjects", "term")
    by_subject = seen.groupBy("term", "subject").agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(1.0) / F.col("n_subjects")).alias("share"))
    # A window over the small counts, so that the edges are read once.
    docs = by_subject.withColumn("docs", F.sum("share").over(Window.partitionBy("term"))).filter(F.round("docs", 9) >= least_docs)
    return docs.select("term", "subject", "n", "docs")


def shares(labels: DataFrame, left_out: Column) -> Column:
    """Share of labelled documents that have the row's subject, without ``left_out`` of them."""
    # One row a subject of the closed list: a bounded table.
    prior = collect_bounded(labels.groupBy("subject").agg(F.count(F.lit(1)).alias("k")), MOST_SUBJECTS)
    every = labels.select("doc_id").distinct().count()
    if not prior:
        return F.lit(1.0)
    k = F.create_map(*[F.lit(x) for r in prior for x in (r.subject, r.k)])[F.col("subject")]
    return F.coalesce((k - left_out) / F.greatest(F.lit(every) - left_out, F.lit(1)), F.lit(1.0))


def learn_terms(counts: DataFrame, keys: list[str], own: Column) -> DataFrame:
    """Verified terms (keys, subject, weight, sure) from counts a key; ``own`` is the subject's share.

    A term of several subjects, such as one that sport and music share, keeps each of them that it
    exceeds by the same lift, if together they are pure enough.
    """
    purity = F.least((F.col("n") + 0.5 * own) / (F.col("docs") + 0.5), F.lit(1.0))
    lifted = counts.withColumn("weight", purity).withColumn("sure", F.col("n") / (F.col("docs") + 2)).filter((purity >= LEAST_SHARE) & (purity >= LEAST_LIFT * own))
    term = Window.partitionBy(*keys)
    pure = lifted.withColumn("sum", F.sum("weight").over(term)).withColumn("top", F.max("weight").over(term))
    return pure.filter((F.col("sum") >= LEAST_SUM) & (F.col("top") >= LEAST_PURITY)).select(*keys, "subject", F.round("weight", 2).alias("weight"), F.round("sure", 2).alias("sure"))


def without_own(counts: DataFrame, words: DataFrame, labels: DataFrame, least_docs: int) -> DataFrame:
    """Verified terms of every seed (doc_id, term, subject, weight, sure), as if the seed had no label."""
    # What no document's own label could lift over the thresholds is left out: the words of any project.
    most = (F.col("n") + 0.5) / (F.col("docs") - 0.5)
    some = counts.filter((most >= LEAST_SHARE) & (most >= LEAST_LIFT * shares(labels, F.lit(1))))
    mine = words.join(broadcast_if_small(some), "term").join(labels.select("doc_id", "subject", F.lit(1).alias("mine")), ["doc_id", "subject"], "left")
    mine = mine.join(labels.select("doc_id", F.lit(1).alias("one")).distinct(), "doc_id", "left").withColumn("mine", F.coalesce("mine", F.lit(0)))
    left = mine.withColumn("n", F.col("n") - F.col("mine")).withColumn("docs", F.round(F.col("docs") - F.coalesce("one", F.lit(0)), 9))
    return learn_terms(left.filter((F.col("n") > 0) & (F.col("docs") >= least_docs)), ["doc_id", "term"], shares(labels, F.col("mine")))


def sentence_subjects(words: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """(doc_id, subject, n_sentences): sentences by the subject their verified terms speak for.

    Where terms of a sentence belong to several subjects, what the whole document speaks for decides.
    """
    # One shuffle, of the verified terms alone: all that follows is within a document.
    spoken = words.join(broadcast_if_small(known), keys).repartition("doc_id")
    votes = spoken.groupBy("doc_id", "sent_no", "subject").agg(F.sum("weight").alias("w"), F.max("sure").alias("sure"), F.min("term").alias("lo"), F.max("term").alias("hi"))
    whole = votes.withColumn("v", F.col("w") * F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id", "subject")))
    first = Window.partitionBy("doc_id", "sent_no").orderBy(F.desc("v"), F.desc("subject"))
    top = whole.withColumn("r", F.row_number().over(first)).filter("r = 1")
    # Whether there are two different terms is all that is asked: the smallest and the largest tell.
    return top.groupBy("doc_id", "subject").agg(F.count(F.lit(1)).alias("n_sentences"), F.when(F.min("lo") < F.max("hi"), 2).otherwise(1).alias("n_terms"), F.max("sure").alias("sure"))


def enough(found: DataFrame) -> Column:
    several = (F.col("n_sentences") >= LEAST_SENTENCES) & (F.col("n_terms") >= LEAST_TERMS)
    return several | ((F.col("n_sentences") > LEAST_SENTENCES) & (F.col("sure") >= SURE))


def tried_seeds(sents: DataFrame, given: DataFrame, scratch: Scratch) -> DataFrame:
    """The given labels without mistakes, as (doc_id, subject, trusted)."""
    seed_sents = scratch.write(sents.join(broadcast_if_small(given.select("doc_id").distinct()), "doc_id", "left_semi"), "seed-sentences")
    words, current = edges_of(seed_sents), _counted(given)
    counts = scratch.write(count_terms(words, current, SEED_DOCS), "seed-counts")
    own = scratch.write(without_own(counts, words, current, SEED_DOCS), "seed-terms")
    found = sentence_subjects(said(seed_sents), own, ["doc_id", "term"]).join(given.withColumn("given", F.lit(True)), ["doc_id", "subject"], "left")
    # A given label needs as many sentences as any other, but they may share one term.
    kept = scratch.write(found.filter(enough(found) | (F.col("given") & (F.col("n_sentences") >= LEAST_SENTENCES))).select("doc_id", "subject", F.coalesce("given", F.lit(False)).alias("given")), "supported")
    full = seed_sents.filter(F.size("sents") >= LEAST_SENTENCES).select("doc_id")
    of = kept.groupBy("doc_id").agg(F.max(~F.col("given")).alias("other"))
    told = given.join(kept.filter("given").select("doc_id", "subject", F.lit(True).alias("trusted")), ["doc_id", "subject"], "left").join(of, "doc_id", "left").join(full, "doc_id", "left_semi")
    silent = F.col("other").isNull()
    return scratch.write(told.filter(F.col("trusted") | silent | ~F.col("other")).select("doc_id", "subject", F.coalesce("trusted", silent).alias("trusted")), "tried")


def assign_subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame, rounds: int | None = None, log: list | None = None) -> DataFrame:
    """(doc_id, subject, n_sentences) of every document and each of its subjects, after ``rounds`` or when no label changes any more.

    A seed has its trusted subjects whatever is found; without sentences found for one, their number is 0.
    ``log`` takes a line a round: (round, labels, verified terms, labels new or gone).
    """
    scratch = Scratch(documents.sparkSession, "subjects")
    sents = scratch.write(sentences(documents), "sentences")
    closed = areas.select("subject").filter(F.col("subject").isNotNull()).distinct()
    given = labels.select("doc_id", "subject").filter(F.col("doc_id").isNotNull()).distinct().join(broadcast_if_small(closed), "subject", "left_semi")
    given = scratch.write(given.join(sents.select("doc_id"), "doc_id", "left_semi"), "seeds")
    tried = tried_seeds(sents, given, scratch)
    trusted = tried.filter("trusted").select("doc_id", "subject")
    result = scratch.write(trusted.withColumn("n_sentences", F.lit(0).cast("bigint")), "labels")
    current, seen, k = scratch.write(_counted(tried.select("doc_id", "subject")), "current"), set(), 0
    edges, parts, fixed, known, kept = edges_of(sents), said(sents), None, None, None
    while rounds is None or k < rounds:
        counts = scratch.write(count_terms(edges, current, SEED_DOCS if k == 0 else LEAST_DOCS), "counts")
        before, known = known, learn_terms(counts, ["term"], shares(current, F.lit(0)))
        if fixed is not None:
            known = known.unionByName(fixed)
        known = scratch.write(known, "known")
        if k == 1:
            # Verified by enough documents: the term's edges stay as they are. Enough and not verified: they go.
            decided, verified = counts.filter(F.col("docs") >= ENOUGH_DOCS).select("term").distinct(), known.select("term").distinct()
            fixed = scratch.write(known.join(decided, "term", "left_semi"), "fixed")
            useless = scratch.write(decided.join(verified, "term", "left_anti"), "useless")
            left = parts = scratch.write(parts.join(broadcast_if_small(useless), "term", "left_anti"), "edges-left")
            edges = scratch.write(left.join(broadcast_if_small(fixed.select("term").distinct()), "term", "left_anti").select("doc_id", "term").distinct(), "open-edges")
        elif k > 1:
            # Only documents with edges that begin, end or change have to be looked at again.
            moved = known.exceptAll(before).unionByName(before.exceptAll(known)).select("term").distinct()
            touched = scratch.write(edges.join(broadcast_if_small(scratch.write(moved, "moved")), "term", "left_semi").select("doc_id").distinct(), "touched")
            parts = left.join(broadcast_if_small(touched), "doc_id", "left_semi")
        found = sentence_subjects(parts, known, ["term"])
        found = found.filter(enough(found)).select("doc_id", "subject", "n_sentences")
        if k > 1:
            found = found.unionByName(kept.join(broadcast_if_small(touched), "doc_id", "left_anti"))
        kept, last = scratch.write(found, "kept"), result
        result = scratch.write(kept.join(trusted, ["doc_id", "subject"], "full").select("doc_id", "subject", F.coalesce("n_sentences", F.lit(0)).cast("bigint").alias("n_sentences")), "labels")
        # Labels that were there before, in the last round or an earlier one, would only come again.
        state = tuple(result.agg(F.count(F.lit(1)), F.sum(F.xxhash64("doc_id", "subject").cast("decimal(20,0)"))).first())
        k += 1
        if log is not None:
            pairs = ["doc_id", "subject"]
            log.append((k, state[0], known.select("term").distinct().count(), result.join(last, pairs, "left_anti").count(), last.join(result, pairs, "left_anti").count()))
        if state in seen:
            break
        seen.add(state)
        current = scratch.write(_counted(result.select("doc_id", "subject")), "current")
    scratch.remove(result)
    return result


def _counted(pairs: DataFrame) -> DataFrame:
    n = pairs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_subjects"))
    return pairs.join(n, "doc_id")


def composition(documents: DataFrame, assigned: DataFrame) -> DataFrame:
    """Per subject: documents, characters, and their share of all documents and characters."""
    docs = documents.select("doc_id", F.length("text").alias("chars")).groupBy("doc_id").agg(F.max("chars").alias("chars"))
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")).first()
    per = assigned.select("doc_id", "subject").distinct().join(docs, "doc_id").groupBy("subject").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("chars").alias("n_chars"))
    share = lambda a, b: F.round(F.col(a) / F.lit(max(1, b or 0)), 6)
    return per.select("subject", "n_docs", "n_chars", share("n_docs", total.n).alias("doc_share"), share("n_chars", total.chars).alias("char_share"))
