"""Operator 12: URL filter, rules first, then a logistic regression on hashed character n-grams.

Rules name a host and the start of a path; a rule fits its host and every subdomain, the longest fitting rule decides.
Rules are a small list, so they are one SQL expression per row. The other URLs go by a model: n-grams of three to five
bytes of host and of path (kept apart), hashed into ``BUCKETS`` places, trained on the driver from a small labelled table
(at most ``MAX_LABELLED`` rows, the first by a hash of the URL) and scored in Arrow batches on the executors. The model is
one array of fixed size, so what a task carries does not grow with the data. No shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.common import lower_ascii, text_batches
from storelens.session import ship_package

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
MAX_LABELLED = 20_000

# The contract's rules, as (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Words of sites to block and to keep; ``seed_urls`` puts them into addresses of the same shapes, so that only the words tell.
BLOCK_WORDS = """casino poker slots jackpot roulette betting bets gambling lottery win-money pills viagra pharmacy-cheap cheap-meds
steroids weight-loss porn xxx adult sex-cams escort nude hookup payday-loan quick-loan fast-cash get-rich crypto-profit forex-signals
spam spam-links link-farm seo-farm content-farm ads adserver ad-track tracker click-track popunder doorway replica-watches fake-bags
counterfeit warez cracked keygen torrent-free serials malware phish login-verify free-prizes free-gift winner-claim""".split()
KEEP_WORDS = """news daily-times journal herald gazette weather radio museum library archive university college school science
physics biology chemistry history math research institute docs developer wiki encyclopedia dictionary forum community blog travel
recipes cooking kitchen garden music theatre film books poetry art photo sports football running cycling health clinic hospital
parents kids city council government law court economy bank insurance shop-tools bakery restaurant hotel railway airport cars
energy water climate forest animals birds farming village church festival the north river stone thing station nation mother
brother weather-station other whether those house horse street central monde presse journal-du-soir zeitung nachrichten
wetter rathaus noticias diario ciudad escuela biblioteca musique cuisine ecole jardin verein garten""".split()
_HOSTS = ("{}.org", "www.{}.net", "{}-{}.com", "blog.{}.org", "m.{}.com", "{}{}.net", "{}.example.org", "www.{}.example.net")
_PATHS = ("/en/{}", "/de/{}.html", "/", "/fr/{}/", "/{}", "/es/{}?page=2", "/archive/{}/index.html", "")


def seed_urls() -> list[tuple[str, int]]:
    """The default labelled table: (url, 1 to block or 0 to keep), the words above in hosts, and some of them in paths."""
    rows = []
    for label, words in ((1, BLOCK_WORDS), (0, KEEP_WORDS)):
        for i, w in enumerate(words):
            other = words[(i * 7 + 3) % len(words)]
            for k in range(3):
                host = _HOSTS[(i + 3 * k) % len(_HOSTS)].format(w, other)
                rows.append((f"https://{host}{_PATHS[(i + k) % len(_PATHS)].format(100 + 37 * i + k)}", label))
            rows.append((f"http://site{i % 9}.org/{w}/{other}", label))
    return rows


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.when(known, lower_ascii(host)).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits (host and path together; then the longer host); null if none."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(texts: list[bytes], salt: int):
    """Row numbers and buckets of every n-gram of ``^text$``, over the joined bytes of a batch."""
    import numpy as np

    size = np.array([len(t) + 2 for t in texts], "i8")
    flat = np.frombuffer(b"".join(b"\x01" + t + b"\x02" for t in texts), "u1").astype("u8")
    row = np.repeat(np.arange(len(texts)), size)
    end = np.cumsum(size)[row]  # where a row's bytes end
    rows, buckets = [], []
    for n in GRAMS:
        at = np.flatnonzero(np.arange(len(flat)) + n <= end)
        h = np.full(len(at), salt * 31 + n, "u8")
        for k in range(n):
            h = (h ^ flat[at + k]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        rows.append(row[at])
        buckets.append((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype("i8") % BUCKETS)
    return np.concatenate(rows), np.concatenate(buckets)


def _parts(hosts: list[str], paths: list[str]):
    """For hosts and for paths: rows, buckets and the number of n-grams a row has."""
    import numpy as np

    for salt, texts in ((1, hosts), (2, paths)):
        rows, buckets = _grams([t.encode("utf-8", "surrogatepass") for t in texts], salt)
        yield rows, buckets, np.maximum(np.bincount(rows, minlength=len(texts)), 1)


@dataclass
class UrlModel:
    """Weights by bucket and the intercept; ``probability`` is that of a URL to block."""

    weights: object
    intercept: float

    def probability(self, hosts: list[str], paths: list[str]):
        import numpy as np

        z = np.full(len(hosts), self.intercept)
        for rows, buckets, n in _parts(hosts, paths):
            z += np.bincount(rows, self.weights[buckets], len(hosts)) / np.sqrt(n)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_urls(labelled: list[tuple[str, int]], rounds: int = 1000, rate: float = 2.0, ridge: float = 1e-6) -> UrlModel:
    """Logistic regression by gradient steps with per-weight rates on the labelled URLs (1 = block)."""
    import re

    import numpy as np

    found = [re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "") for u, _ in labelled]
    hosts = [m[1].translate({c: c + 32 for c in range(65, 91)}) if m else "" for m in found]
    paths = [m[2] if m else "" for m in found]
    y = np.array([k for _, k in labelled], "f8")
    parts = list(_parts(hosts, paths))
    w, b = np.zeros(BUCKETS), 0.0
    past, past_b = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(rounds if len(y) else 0):
        z = np.full(len(y), b)
        for rows, buckets, n in parts:
            z += np.bincount(rows, w[buckets], len(y)) / np.sqrt(n)
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        grad = ridge * w
        for rows, buckets, n in parts:
            grad += np.bincount(buckets, (error / np.sqrt(n))[rows], BUCKETS) / len(y)
        past, past_b = past + grad**2, past_b + error.mean() ** 2
        w, b = w - rate * grad / np.sqrt(past), b - rate * error.mean() / past_b**0.5
    return UrlModel(w.astype("f8"), float(b))


def labelled_urls(labelled: DataFrame | None, url_col: str = "url", label_col: str = "label") -> list[tuple[str, int]]:
    """Rows of the labelled table, the first ``MAX_LABELLED`` by a hash of the URL; the default table if none is given."""
    if labelled is None:
        return seed_urls()
    rows = (labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("int").alias("label")).dropna()
            .orderBy(F.xxhash64("url"), "url", "label").limit(MAX_LABELLED))
    return [(r["url"], r["label"]) for r in rows.collect()]


def judge_urls(pages: DataFrame, model: UrlModel | None = None, rules=RULES, threshold: float = 0.5, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, p_block``.

    ``verdict`` is the rule's, else ``block`` where the model's probability ``p_block`` is at least ``threshold``. A null URL
    and one without ``://`` have empty host and path and are judged as such (an empty address is kept: the model sees no
    n-gram but its ends). Null ids are kept, repeated rows are judged each, URLs of any length whole; other columns are
    ignored; an empty table gives no rows.
    """
    spark: SparkSession = pages.sparkSession
    model = model or fit_urls(labelled_urls(None))
    ship_package(spark)
    text_batches(spark)
    weights = spark.sparkContext.broadcast((model.weights.astype("f4").tobytes(), model.intercept))

    def score(batches):
        import numpy as np
        import pyarrow as pa

        raw, intercept = weights.value
        fitted = UrlModel(np.frombuffer(raw, "f4").astype("f8"), intercept)
        for batch in batches:
            p = fitted.probability(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, "p_block"])

    host, path = split_url(F.col(url_col))
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    scored = parts.mapInArrow(score, "page_id long, host string, path string, p_block double")
    ruled = scored.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    guess = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                        F.coalesce("found.verdict", guess).alias("verdict"), "p_block")
