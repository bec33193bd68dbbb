"""Source files that are not hand-written: generated, minified, vendored, or data kept as code.

Three linear support-vector classifiers on hashed features judge a file:

* body: character n-grams of the code lines, as they are with digits alike, and as skeletons in which
  all letters of a case are alike. Comment lines are masked, so no giveaway header is seen;
* path: components, hashed: directory names and the tail of the file name;
* comment: character n-grams of single comment lines; the highest line counts. It is apart because a file
  whose header is all that tells it from hand-written code is a case too, and the two above never see it.

A file is not hand-written when any of them gives more than zero. Scores are sums over n-grams, so
each chunk is scored where it lies and only three numbers a chunk are shuffled to its file.

There are no labels. Labelling functions give weak ones to a sample of whole files of about
``TRAIN_CHUNKS`` chunks and ``TRAIN_TOTAL`` bytes, documented bounds: tool and copy headers, vendor
directories, tool suffixes, and the shape of the text (digits, lines without blanks, few line
skeletons). The sample is split by repository: three quarters of the repositories fit, the others choose
the threshold at which each classifier agrees best with the labels (``choose``). Each is refitted after
rows that it contradicts are dropped, so that unmarked machine-made files among the negatives and plain
bodies under a header do no harm. ``validate`` fits so on the sampled files of half the repositories and
tests on every file of the other half.

Nulls: a null repo is a repo of its own; a row without file_path is no file; null or empty bodies add
nothing. Files with a ``doc_file`` chunk are never cases. Repeated rows add the same evidence again
and do not change a decision's sign. With fewer than two classes in the sample a classifier says no.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of the training sample: chunks and bytes in all, bytes of one chunk and chunks of one file; what is larger is judged but not learned from.
TRAIN_CHUNKS, TRAIN_TOTAL, TRAIN_BYTES, TRAIN_FILE = 16_000, 1 << 26, 1 << 16, 1_000
#: Held-out positives from which they choose a threshold.
LEAST_HELD = 20
#: Size of the hashed feature space.
DIM = 1 << 17
SCALE = 200.0

_COMMENT = re.compile(r"^\s*(?:#|//|/?\*|\"\"\"|'''|<!--|--\s|;)")
# Words of headers that tools and copies leave, used as labels only: that a file is made by a tool, in four
# languages; that it must not be changed here; where it was copied from; a library's name and version.
_HEADER = re.compile(
    r"\b(?:do not|don't) (?:edit|modify|change|patch|touch)\b|@generated|\b(?:auto(?:matically)?|machine)[ -]?(?:generated|created|written|produced)\b|\bcode generated\b|^\W*(?:this file (?:is|was) )?(?:generated|produced|created|emitted) by \S+ (?:from|on)\b"
    r"|automatisch (?:erzeugt|erstellt|generiert)|generado autom[aá]ticamente|g[eé]n[eé]r[eé] automatiquement|\b(?:copied|vendored|taken) (?:verbatim )?from\b|\bimported from [\w./-]+@|copyright \(c\) the \w+ authors"
    r"|^\W*[a-z][\w-]+ v?\d+\.\d+\.\d+\W*$|^\W*[a-z][\w-]+ v\d+\.\d+\.\d+ |sourcemappingurl=|^\s*/\*!",
    re.I,
)
# A comment that says the opposite: written by hand, or that other files are made from this one.
_SPOKEN = re.compile(r"hand-?written|\b(?:written|kept|made|maintained) by hand\b|(?:generated|produced|created) (?:from|by) this (?:file|script|module|package|tool)\b", re.I)
_VENDOR = re.compile(r"(?:^|/)(?:vendor|_vendor|node_modules|site-packages|godeps|third[_-]?party|external|bower_components|jspm_packages|pods|carthage)/", re.I)
_SUFFIX = re.compile(r"[.-](?:min|bundle|gen|generated|pb)\.\w+$|_pb2(?:_grpc)?\.pyi?$|_pb\.(?:js|ts|rb|php)$|(?:^|/)zz_generated[^/]*$", re.I)
_STRING = re.compile(r"\"[^\"]*\"|'[^']*'|`[^`]*`")
_NUMBERS = re.compile(r"\d+")
_WORD = re.compile(r"\w*\d\w*|[^\W\d]\w*")
_BLOB = re.compile(r"[\s\"']*[A-Za-z0-9+/=]{48,}[\s\"',;+\\]*")

_ALIKE_DIGITS = bytes(48 if 48 <= i < 58 else i for i in range(256))
_SKELETON = bytes(48 if 48 <= i < 58 else 97 if 97 <= i < 123 or i == 95 or i > 127 else 65 if 65 <= i < 91 else i for i in range(256))


def grams(data: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashed n-grams that begin at each byte but the last n - 1."""
    m = len(data) - n + 1
    if m <= 0:
        return np.empty(0, np.uint32)
    h = np.full(m, seed, np.uint32)
    for k in range(n):
        h *= np.uint32(0x01000193)
        h ^= data[k : k + m]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    h &= np.uint32(DIM - 1)
    return h


def split_lines(body: str) -> tuple[str, list[str]]:
    """Code and comment lines of a body; the code keeps its line ends."""
    code, comments = [], []
    for line in body.split("\n"):
        (comments if _COMMENT.match(line) else code).append(line)
    return "\n".join(code), comments


def _code_grams(code: str) -> np.ndarray:
    raw = code.encode("utf-8", "replace")
    return np.concatenate([grams(np.frombuffer(raw.translate(t), np.uint8), n, seed) for t, n, seed in ((_ALIKE_DIGITS, 4, 1), (_SKELETON, 8, 2))])


def _line_grams(line: str) -> np.ndarray:
    data = np.frombuffer(line.strip().lower().encode("utf-8", "replace").translate(_ALIKE_DIGITS), np.uint8)
    return np.concatenate([grams(data, 5, 3), grams(data, 8, 4)])


def path_features(path: str) -> list[str]:
    """Directory names without short random endings, and the end of the file name."""
    *dirs, name = path.lower().split("/")
    parts = [re.sub(r"[-_][0-9a-z]{1,4}$|\d+", "", d) or d for d in dirs]
    tails = re.split(r"(?=[._-])", name)
    return sorted({f"d:{p}" for p in parts} | {"t:" + "".join(tails[-2:])} | ({f"h:{name[:12]}"} if name.startswith("zz") else set()))


def _hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace"))


def shape_label(text: str) -> bool:
    """Whether a file's shape is a machine's: digits, blobs, lines without blanks, few line skeletons, or lines that count up."""
    n = max(1, len(text))
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    code = [x for x in lines if not _COMMENT.match(x)]
    digits, blanks = sum(map(text.count, "0123456789")) / n, sum(map(text.count, " \t\n")) / n
    long = sum(len(x) for x in code if len(x) > 300)
    if len(text) > 200 and digits > 0.3 or blanks < 0.08 and long > 0.85 * sum(map(len, code)) > 0:
        return True
    if lines and len(text) > 200 and sum(bool(_BLOB.fullmatch(x)) for x in lines) / len(lines) > 0.5:
        return True
    if len(code) < 8:
        return False
    alike: dict[str, list[int]] = defaultdict(list)
    for x in code:
        n = _NUMBERS.findall(x)
        alike[_WORD.sub("w", _STRING.sub("S", x))].append(int(n[-1][:9]) if n else -1)
    if len(code) >= 12 and len(alike) <= 4:
        return True
    # lines alike but for a number that counts up
    for n in alike.values():
        if len(n) >= 6 and len(n) >= 0.12 * len(code) and sum(b == a + 1 for a, b in zip(n, n[1:])) >= 0.7 * (len(n) - 1):
            return True
    return False


def fit_svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, positive: float, negative: float, rounds: int = 8, seed: int = 0) -> tuple[np.ndarray, float]:
    """Linear support-vector classifier by dual coordinate descent; rows are (features, values)."""
    w, b = np.zeros(DIM), 0.0
    alpha, norm = np.zeros(len(rows)), np.array([(v * v).sum() * SCALE * SCALE + 1 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for j in order.permutation(len(rows)):
            i, v = rows[j]
            g = y[j] * (SCALE * (w[i] @ v) + b) - 1
            a = min(max(alpha[j] - g / norm[j], 0), positive if y[j] > 0 else negative)
            step = (a - alpha[j]) * y[j]
            if step:
                alpha[j] = a
                w[i] += step * SCALE * v
                b += step
    return w * SCALE, b


def counted(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, n = np.unique(features, return_counts=True)
    return i.astype(np.int64), n / max(1, n.sum())


def fit_noisy(rows: list, y: np.ndarray, positive: float = 8.0, rounds: int = 4, drop: float = -0.3) -> tuple[np.ndarray, float]:
    """Fits again and again, each time without the rows whose weak label the last fit contradicts."""
    if len(set(y.tolist())) < 2:
        return np.zeros(DIM), -1.0
    keep, w, b = np.arange(len(rows)), np.zeros(DIM), -1.0
    for k in range(rounds):
        if len(set(y[keep].tolist())) < 2:
            break
        w, b = fit_svm([rows[j] for j in keep], y[keep], positive, 1.0 if k else 0.1)
        s = np.array([w[i] @ v + b for i, v in rows])
        keep = np.flatnonzero((y > 0) & (s > drop) | (y < 0) & (s < drop))
    return w, b


def choose(scores: np.ndarray, y: np.ndarray) -> float:
    """The threshold at which scores of held-out repositories agree best with their labels, by F1; the nearest to 0 of those as good."""
    if len(set(y.tolist())) < 2 or (y > 0).sum() < LEAST_HELD:
        return 0.0
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(y[order] > 0)
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + (y > 0).sum())
    below = np.append(s[1:], s[-1] - 2.0)
    middle = (s + below) / 2  # between a score taken and the next
    ok = (below < s) & (f1 >= f1[below < s].max() - 0.005)
    kept = (scores > 0).sum()
    if kept and 2 * ((y > 0) & (scores > 0)).sum() / (kept + (y > 0).sum()) >= f1[ok].max() - 0.005:
        return 0.0
    return float(middle[ok][np.argmin(np.abs(middle[ok]))])


def _fit_split(rows: list, y: list, repos: list, **how) -> tuple[np.ndarray, float]:
    """Fits on three quarters of the repositories and sets the bias by the others."""
    y, held = np.array(y), np.array([_hash(f"held {r}") % 4 == 0 for r in repos], bool)
    if held.all() or len(set(y[~held].tolist())) < 2:
        held[:] = False
    w, b = fit_noisy([rows[j] for j in np.flatnonzero(~held)], y[~held], **how)
    tried = np.flatnonzero(held)
    return w, b - choose(np.array([w[rows[j][0]] @ rows[j][1] + b for j in tried]), y[held])


class Model:
    """The three classifiers, small enough to travel with the tasks."""

    def __init__(self, files: dict[tuple, list[str]]):
        bodies, body_y, body_of, lines, line_of, paths, path_y, path_of = [], [], [], {}, {}, [], [], []
        known: dict[int, int] = {}  # hashed path components of the sample; others mean nothing
        for (repo, path), chunks in files.items():
            text = "\n".join(chunks)
            code, comments = split_lines(text)
            header = False
            for c in comments:
                giveaway = bool(_HEADER.search(c)) and not _SPOKEN.search(c)
                header |= giveaway
                line = re.sub(r"\d", "0", c.strip().lower())
                lines[line], line_of[line] = giveaway, repo
            vendored, suffixed, shaped = bool(_VENDOR.search(path)), bool(_SUFFIX.search(path)), shape_label(text)
            # A copied body is somebody's handiwork, and a header may stand over a plain body: neither is taught to the body classifier.
            if code.strip() and (suffixed or shaped or not (header or vendored)):
                bodies.append(counted(_code_grams(code)))
                body_y.append(1 if suffixed or shaped else -1)
                body_of.append(repo)
            f = np.array([known.setdefault(_hash(w), len(known) % DIM) for w in path_features(path)], np.int64)
            paths.append((f, np.full(len(f), 0.02)))
            path_y.append(1 if vendored or suffixed else -1)
            path_of.append(repo)
        self.body, self.body_bias = _fit_split(bodies, body_y, body_of)
        texts = sorted(lines)
        self.line, self.line_bias = _fit_split([counted(_line_grams(t)) for t in texts], [1 if lines[t] else -1 for t in texts], [line_of[t] for t in texts])
        w, self.path_bias = _fit_split(paths, path_y, path_of, positive=64.0, drop=-0.9)
        self.path = {f: float(w[i]) for f, i in known.items() if w[i]}
        self.body, self.line = self.body.astype(np.float32), self.line.astype(np.float32)

    def path_score(self, path: str) -> float:
        return 0.02 * sum(self.path.get(_hash(f), 0.0) for f in path_features(path)) + self.path_bias

    def score(self, bodies: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per body: sum of its n-grams' weights, their number, and its highest comment line."""
        sums, counts, tops = np.zeros(len(bodies)), np.zeros(len(bodies)), np.full(len(bodies), -1e9)
        lines, owner = [], []
        for k, body in enumerate(bodies):
            if body:
                code, comments = split_lines(body)
                g = _code_grams(code)
                sums[k], counts[k] = self.body[g].sum(dtype=np.float64), len(g)
                for c in comments:
                    lines.append(c.strip().lower())
                    owner.append(k)
        if lines:
            raw = [x.encode("utf-8", "replace").translate(_ALIKE_DIGITS) for x in lines]
            size = np.array([len(x) for x in raw])
            data = np.frombuffer(b"\n".join(raw) + b"\n" * 8, np.uint8)
            start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
            total, number = np.zeros(len(raw)), np.zeros(len(raw))
            for n, seed in ((5, 3), (8, 4)):
                run = np.concatenate([[0.0], np.cumsum(self.line[grams(data, n, seed)], dtype=np.float64)])
                m = np.maximum(size - n + 1, 0)
                total += run[start + m] - run[start]
                number += m
            np.maximum.at(tops, np.array(owner), np.where(number > 0, total / np.maximum(number, 1) + self.line_bias, -1e9))
        return sums, counts, tops


def training_files(chunks: DataFrame, bound: int = TRAIN_CHUNKS, total_bytes: int = TRAIN_TOTAL) -> dict[tuple, list[str]]:
    """Whole files chosen by a hash of their name, about ``bound`` chunks and at most about ``total_bytes`` in all."""
    size = F.coalesce(F.octet_length("body"), F.lit(0))
    rows = chunks.filter(F.col("file_path").isNotNull() & (F.coalesce("ent_type", F.lit("")) != "doc_file"))
    n, n_bytes = rows.select(F.count(F.lit(1)), F.coalesce(F.sum(F.when(size <= TRAIN_BYTES, size)), F.lit(0))).first()
    share = min(1.0, bound / max(1, n), total_bytes / max(1, n_bytes))
    space = 1 << 40
    place = F.pmod(F.xxhash64("repo", "file_path"), F.lit(space))
    picked = rows.filter((place < int(share * space)) & (size <= TRAIN_BYTES)).select("repo", "file_path", "chunk_id", F.coalesce("body", F.lit("")).alias("body"))
    # A file with more chunks than many files together would not be a sample.
    small = picked.groupBy("repo", "file_path").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= TRAIN_FILE).select(F.col("repo").alias("_r"), F.col("file_path").alias("_p"))
    picked = picked.join(small, F.col("repo").eqNullSafe(F.col("_r")) & (F.col("file_path") == F.col("_p")), "left_semi")
    pdf = picked.toPandas().drop_duplicates().sort_values(["repo", "file_path", "chunk_id"], na_position="first")
    return {k: g["body"].tolist() for k, g in pdf.groupby(["repo", "file_path"], sort=True, dropna=False)}


def score_files(chunks: DataFrame, model: Model) -> DataFrame:
    """(repo, file_path, body_score, comment_score, path_score, is_doc) of every file."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        m, known = shared.value, {}
        for batch in batches:
            sums, counts, tops = m.score(batch["body"].tolist())
            scores = []
            for p in batch["file_path"]:
                if p not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[p] = m.path_score(p)
                scores.append(known[p])
            yield pd.DataFrame({"repo": batch["repo"], "file_path": batch["file_path"], "is_doc": batch["is_doc"], "total": sums, "n": counts, "comment_score": tops, "path_score": scores})

    rows = chunks.filter(F.col("file_path").isNotNull()).select("repo", "file_path", (F.coalesce("ent_type", F.lit("")) == "doc_file").alias("is_doc"), "body")
    scored = rows.mapInPandas(scan, "repo string, file_path string, is_doc boolean, total double, n double, comment_score double, path_score double")
    return (
        scored.groupBy("repo", "file_path")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("comment_score").alias("comment_score"), F.max("path_score").alias("path_score"), F.max("is_doc").alias("is_doc"))
        .select("repo", "file_path", F.when(F.col("n") > 0, F.col("total") / F.col("n") + model.body_bias).otherwise(-1.0).alias("body_score"), "comment_score", "path_score", "is_doc")
    )


def found(scores: DataFrame) -> DataFrame:
    return scores.filter(~F.col("is_doc") & (F.greatest("body_score", "comment_score", "path_score") > 0))


def find_not_handwritten(chunks: DataFrame) -> DataFrame:
    """Distinct (repo, file_path) of files that are not hand-written source."""
    return found(score_files(chunks, Model(training_files(chunks)))).select("repo", "file_path")


def weak_label(path: str, text: str) -> bool:
    """Whether any labelling function takes a whole file for one that is not hand-written."""
    return bool(_VENDOR.search(path) or _SUFFIX.search(path) or shape_label(text) or any(_HEADER.search(c) and not _SPOKEN.search(c) for c in split_lines(text)[1]))


def weak_labels(chunks: DataFrame) -> DataFrame:
    """(repo, file_path, given) of every file: the weak label of its chunks in order, whatever their size."""

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.drop_duplicates().sort_values("chunk_id", na_position="first")
        repo, path = pdf["repo"].iloc[0], pdf["file_path"].iloc[0]
        return pd.DataFrame({"repo": pd.Series([repo], dtype=object), "file_path": [path], "given": [weak_label(path, "\n".join(one["body"]))]})

    rows = chunks.filter(F.col("file_path").isNotNull()).select("repo", "file_path", "chunk_id", F.coalesce("body", F.lit("")).alias("body"))
    return rows.groupBy("repo", "file_path").applyInPandas(label, "repo string, file_path string, given boolean")


def held_out(chunks: DataFrame) -> DataFrame:
    """Chunks of the repositories that ``validate`` tests on, without documents."""

    @F.pandas_udf("boolean")
    def tested(repo: pd.Series) -> pd.Series:
        return repo.map({r: _hash(str(r)) % 2 == 0 for r in repo.unique()}).astype(bool)

    return chunks.filter((F.coalesce("ent_type", F.lit("")) != "doc_file") & tested(F.coalesce("repo", F.lit("nan"))))


def validate(chunks: DataFrame) -> DataFrame:
    """Held-out agreement with the weak labels: fitted on the sampled half of the repositories, tested on every file of the others."""
    half = {k: v for k, v in training_files(chunks).items() if _hash(str(k[0])) % 2}
    model, rest = Model(half), held_out(chunks)
    scores = score_files(rest, model).select("repo", "file_path", (F.greatest("body_score", "comment_score", "path_score") > 0).alias("said"))
    labels = weak_labels(rest).select(F.col("repo").alias("r"), F.col("file_path").alias("p"), "given")
    both = labels.join(scores, F.col("r").eqNullSafe(F.col("repo")) & (F.col("p") == F.col("file_path")))
    count = lambda given, said: F.count(F.when((F.col("given") == given) & (F.col("said") == said), 1))
    return both.agg(
        F.lit(len(half)).cast("bigint").alias("n_train"), F.count(F.lit(1)).alias("n_test"),
        count(True, True).alias("both"), count(False, True).alias("only_classifier"), count(True, False).alias("only_weak_label"), count(False, False).alias("neither"),
    )
