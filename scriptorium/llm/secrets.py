"""Secret scans: fixed patterns, and two character Markov models compared by their log-likelihood ratio.

The patterns find keyed assignments, access keys and long hexadecimal runs. What they leave is looked through for
other random strings: a first-order Markov model of the characters of random strings and one of ordinary
identifiers are trained from labelled samples, and a token is a secret where the first explains it better by a
margin, in all and per character. Of a token that is not one as a whole, such as a path of words that ends in a key, the
stretch that the first explains best is looked at likewise.

Defined results: null and empty texts have no spans; tokens without a letter are numbers, not secrets; extra columns are
kept; texts of any length are scanned whole; repeated texts have equal spans; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import read, small_batches

KINDS = ("assign", "access", "hex", "markov")

# The patterns and least lengths that define the base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that are long enough
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN_LEAST = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % TOKEN_LEAST)
#: A token is random from so much log-likelihood ratio in all, and so much per character.
LLR_LEAST, LLR_PER_CHAR = 12.0, 0.4

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

#: Words from which ordinary identifiers are composed for the labelled samples.
WORDS = (
    "account action active address admin archive array article async author backup balance batch binary block body "
    "buffer build button cache call channel chapter check class client cluster code column command comment commit "
    "common config content context copy count create customer data date debug default delete design detail device "
    "document draft driver editor email entry error event example export factory field file filter final folder "
    "format frame function gateway global group handler header history image import index inner input invoice item "
    "item journal label language large layout length level library limit line linear list local location logger "
    "manager market master member memory message meta method metric mobile model module month name network number "
    "object offset order output owner package page param parent parser path payment person phone photo player plugin "
    "policy pool position post price private process product profile project public query queue random range record "
    "region release remote report request reset resource response result review route sample schema screen search"
).split()


def default_samples(n: int = 1500, seed: int = 11) -> tuple[list[str], list[str]]:
    """Labelled samples from a seeded rule: (random strings, ordinary identifiers), ``n`` of each."""
    rng = random.Random(seed)
    alphabets = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "-_")
    secrets = ["".join(rng.choices(a, k=rng.randint(16, 64))) for a in (rng.choice(alphabets) for _ in range(n))]
    plain = []
    for _ in range(n):
        words = rng.choices(WORDS, k=rng.randint(2, 5))
        style = rng.randrange(6)
        if style == 0:
            name = "_".join(words)
        elif style == 1:
            name = words[0] + "".join(w.title() for w in words[1:])
        elif style == 2:
            name = "-".join(words)
        elif style == 3:
            name = "/".join(words)
        elif style == 4:
            name = "_".join(words).upper()
        else:
            name = "".join(words)
        tail = rng.randrange(6)
        if tail == 1:
            name += rng.choice("_-") + str(rng.randint(1, 9999))
        elif tail == 2:
            name += f"-{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        elif tail == 3:
            name += f"_v{rng.randint(1, 20)}"
        elif tail == 4:
            name += f"/{rng.randint(1990, 2030)}/{rng.randint(1, 12):02d}"
        elif tail == 5:
            name += f"-{rng.choice((320, 640, 1024, 1920))}x{rng.choice((240, 480, 768, 1080))}"
        plain.append(name)
    return secrets, plain


class MarkovRatio:
    """Two first-order character models; ``ratio`` is the log-likelihood of the random one less the ordinary one's."""

    def __init__(self, secrets: list[str], plain: list[str], smooth: float = 0.5):
        self.at = {c: i for i, c in enumerate(ALPHABET)}
        self.table = self._model(secrets, smooth) - self._model(plain, smooth)

    def _ids(self, token: str) -> list[int]:
        start = len(ALPHABET)
        return [start, *(self.at.get(c, start + 1) for c in token)]

    def _model(self, samples: list[str], smooth: float) -> np.ndarray:
        n = len(ALPHABET) + 2
        counts = np.full((n, n), smooth)
        for s in samples:
            ids = np.array(self._ids(s))
            np.add.at(counts, (ids[:-1], ids[1:]), 1)
        return np.log(counts / counts.sum(1, keepdims=True))

    def steps(self, token: str) -> np.ndarray:
        """The log-likelihood ratio of each character after the one before it."""
        ids = np.array(self._ids(token))
        return self.table[ids[:-1], ids[1:]]

    def ratio(self, token: str) -> float:
        return float(self.steps(token).sum())

    def best_stretch(self, token: str) -> tuple[int, int, float] | None:
        """(start, end, ratio) of what is random in a token: all of it, or else the stretch with the greatest ratio
        beyond half the margin of a character; None where that is too short or not random."""
        steps = self.steps(token)
        enough = lambda a, b: b - a >= TOKEN_LEAST and (x := steps[a:b].sum()) >= LLR_LEAST and x >= LLR_PER_CHAR * (b - a)
        if enough(0, len(steps)):
            return 0, len(steps), float(steps.sum())
        sums = np.concatenate([[0.0], np.cumsum(steps - LLR_PER_CHAR / 2)])
        rise = sums - np.minimum.accumulate(sums)
        b = int(rise.argmax())
        a = int(sums[: b + 1].argmin())
        return (a, b, float(steps[a:b].sum())) if enough(a, b) else None


@cache
def default_model() -> MarkovRatio:
    return MarkovRatio(*default_samples())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The pattern spans of a text: (kind, start, end) in code points, by start and then by kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_text(text: str | None, model: MarkovRatio) -> list[dict]:
    """All spans of a text, base ones with score null; spans of the models never overlap base ones."""
    if not text:
        return []
    base = base_spans(text)
    spans = [{"kind": k, "start": a, "end": b, "score": None} for k, a, b in base]
    starts, ends = [x for _, x, _ in base], list(accumulate((y for _, _, y in base), max))
    for m in TOKEN.finditer(text):
        a, b = m.span()
        # Pattern spans begin in order, and the furthest end of those that begin before the token's is known.
        if (n := bisect_left(starts, b)) and ends[n - 1] > a:
            continue
        if not any(c.isalpha() for c in m[0]) or not (found := model.best_stretch(m[0])):
            continue
        spans.append({"kind": "markov", "start": a + found[0], "end": a + found[1], "score": found[2]})
    if len(spans) > len(base):
        spans.sort(key=lambda s: (s["start"], KINDS.index(s["kind"])))
    return spans


def secret_spans(text: Column | str, samples: tuple[list[str], list[str]] | None = None) -> Column:
    """The spans of a text column, as ``SPANS``. samples: (random strings, ordinary identifiers) to train from."""
    model = MarkovRatio(*samples) if samples else default_model()

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.array([scan_text(t.as_py(), model) for t in texts], kind)

    return scan(F.col(text) if isinstance(text, str) else text)


def find_secrets(df: DataFrame, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """``df`` with a column of spans."""
    small_batches(df.sparkSession)
    return df.withColumn(out, secret_spans(text))


def redact_text(text: str | None, model: MarkovRatio, mask: str = "[SECRET]") -> str | None:
    if not text or not (spans := scan_text(text, model)):
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for s in spans:
        if merged and s["start"] < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s["end"])
        else:
            merged.append([s["start"], s["end"]])
    for a, b in merged:
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def redact_secrets(df: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with each secret of its text replaced by ``mask``; other rows and columns stay as they are."""
    small_batches(df.sparkSession)
    model = default_model()

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        return pa.array([redact_text(t.as_py(), model, mask) for t in texts], pa.string())

    return df.withColumn(text, redact(F.col(text)))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every whole text of documents, with counts and a digest of the pattern spans."""
    spans = find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"), out="_spans").select("doc_id", "_spans")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    n = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(F.filter("_spans", lambda s: s["kind"] != "markov"), line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("_spans", line), ",").alias("spans"),
        n("markov").alias("n_markov"),
    )
