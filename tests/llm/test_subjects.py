import datetime as dt
import random

from loomgraph.llm import subjects as S

TOPICS = {
    "health": "patient clinic ward dosage nurse triage vaccine therapy symptom surgery".split(),
    "law": "tribunal statute clause verdict counsel hearing appeal docket bailiff brief".split(),
    "music": "violin choir melody octave refrain tempo chord drummer setlist bassline".split(),
}
FILLER = ["Run the tests before you push.", "Logs go to the queue by default.", "Nothing else changed in this step.", "See the notes in the folder.", "Errors are retried with a short pause."]


def corpus():
    r = random.Random(11)
    docs, truth, labels = [], {}, []
    for i in range(240):
        topics = r.sample(sorted(TOPICS), 2) if i % 5 == 0 else [r.choice(sorted(TOPICS))]
        sents = [f"The {a} is matched with the {b}." for t in topics for _ in range(r.randint(4, 7)) for a, b in [r.sample(TOPICS[t], 2)]]
        sents += r.sample(FILLER, 3)
        if i % 7 == 0:
            sents.append(f"For example the {r.choice(TOPICS[next(t for t in sorted(TOPICS) if t not in topics)])} is elsewhere.")
        r.shuffle(sents)
        docs.append((i, " ".join(sents)))
        truth[i] = set(topics)
        if i < 60:
            labels += [(i, t) for t in topics]
    docs += [(900, "TODO"), (901, None), (902, ""), (903, " ".join(FILLER)), (904, "The violin is matched with the choir.")]
    labels[0] = (labels[0][0], next(t for t in sorted(TOPICS) if t not in truth[labels[0][0]]))  # a mistake
    return docs, truth, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs for _ in range(2 if i % 50 == 0 else 1)], "doc_id bigint, text string, subject string")
    lab = spark.createDataFrame([(i, s, "a", dt.datetime(2024, 1, 1)) for i, s in labels], "doc_id bigint, subject string, annotator string, labelled_at timestamp")
    areas = spark.createDataFrame([(t, "about it") for t in [*sorted(TOPICS), None]], "subject string, description string")
    return d, lab, areas


def test_held_out_documents(spark):
    docs, truth, labels = corpus()
    d, lab, areas = frames(spark, docs, labels + [(None, "law"), (5000, "law"), (7, None), (7, "cooking")])
    found: dict = {}
    for r in S.assign_subjects(d, lab, areas).collect():
        found.setdefault(r.doc_id, set()).add(r.subject)
    held = [i for i in truth if i >= 60]
    assert sum(found.get(i, set()) == truth[i] for i in held) >= 0.97 * len(held)
    assert found.get(labels[0][0]) == truth[labels[0][0]]
    assert not set(found) & {900, 901, 902, 903, 904}


def test_composition_and_empty_tables(spark):
    docs, truth, labels = corpus()
    d, lab, areas = frames(spark, docs, labels)
    got = S.assign_subjects(d, lab, areas)
    rows = {r.subject: r for r in S.composition(d, got).collect()}
    assert set(rows) == set(TOPICS) and all(0 < r.doc_share < 1 for r in rows.values())
    assert S.assign_subjects(d, lab.limit(0), areas).count() == 0
    assert S.assign_subjects(d.limit(0), lab, areas).count() == 0


def test_silent_seeds_keep_their_label(spark):
    """A rare document whose words verify no term has what it was labelled, a stub has not."""
    docs, _, labels = corpus()
    docs += [(950, "Der Pegel steigt am Deich. Die Flut kommt am Abend."), (951, "TODO")]
    d, lab, areas = frames(spark, docs, labels + [(950, "law"), (951, "law")])
    found = {(r.doc_id, r.subject) for r in S.assign_subjects(d, lab, areas).collect()}
    assert (950, "law") in found and 951 not in {i for i, _ in found}


def test_seeds_are_judged_without_their_own_label(spark):
    """Words that a label shares with one other document are verified with it, not without it."""
    rows = [(i, [["quark", "gluon"], ["quark", "gluon"]]) for i in (1, 2)] + [(i, [["choir"], ["violin"]]) for i in range(3, 9)]
    sents = spark.createDataFrame(rows, "doc_id bigint, sents array<array<string>>")
    labels = S._counted(spark.createDataFrame([(i, "law" if i < 3 else "music") for i in range(1, 9)], "doc_id bigint, subject string"))
    counts = S.count_terms(S.edges_of(sents), labels, 2)
    words = spark.createDataFrame([(1, "quark"), (3, "choir")], "doc_id bigint, term string")
    assert {r.term for r in S.learn_terms(counts, ["term"], S.shares(labels, S.F.lit(0))).collect()} >= {"quark"}
    assert {(r.doc_id, r.term, r.subject) for r in S.without_own(counts, words, labels, 2).collect()} == set()


def test_labels_travel_until_they_stop(spark):
    """Each group of documents shares words with the next only: the last is reached after more than three rounds."""
    docs, labels, n = [], [], 7
    word = lambda topic, g, k: topic + "abcdefghij"[g] + "klmnopqrst"[k]
    for t, topic in enumerate(("law", "music", "health")):
        for g in range(n):
            for i in range(20):
                a, b = word(topic, g, i % 4), word(topic, g + 1, i % 4)
                docs.append((t * 1000 + g * 20 + i, f"See {a} {word(topic, g, (i + 1) % 4)} now. Ask {a} {word(topic, g, (i + 2) % 4)} then. Get {b} {a} also."))
                if g == 0:
                    labels.append((t * 1000 + i, topic))
    d, lab, areas = frames(spark, docs, labels)
    found = {(r.doc_id, r.subject) for r in S.assign_subjects(d, lab, areas).collect()}
    assert {(t * 1000 + (n - 1) * 20 + i, topic) for t, topic in enumerate(("law", "music", "health")) for i in range(20)} <= found


def test_trusted_seeds_are_clamped(spark):
    """Labels the other seeds support or say nothing about stay; those against which they speak go."""
    docs, truth, labels = corpus()
    wrong = labels[0]
    d, lab, areas = frames(spark, docs, labels)
    log: list = []
    found = {(r.doc_id, r.subject) for r in S.assign_subjects(d, lab, areas, log=log).collect()}
    assert set(labels) - {wrong} <= found and wrong not in found
    assert log[-1][3:] == (0, 0) and [r[0] for r in log] == list(range(1, len(log) + 1))


def test_repeated_documents_count_once(spark):
    rows = [(1, "The choir sings. The violin plays.", "a")] * 3 + [(1, "Zither and choir. A violin.", "b"), (2, "One choir. Two violins.", None), (None, "Lost choir.", "c")]
    got = S.sentences(spark.createDataFrame(rows, "doc_id bigint, text string, subject string")).collect()
    assert sorted(r.doc_id for r in got) == [1, 2]
    assert [len(x) for x in next(r.sents for r in got if r.doc_id == 1)] == [3, 1]
