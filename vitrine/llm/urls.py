"""Operator 9, URL filters: rules first, then a character language-model ratio. DataFrame functions only.

Rules (host, path prefix, verdict): a rule fits its host and all subdomains where the url's path starts
with the rule's; the longest wins. The pages that rules decide train two smoothed variable-order Markov
models, one of accepted and one of rejected urls. Both models interpolate orders 0 to ORDER - 1 with
Witten-Bell weights, P_k(c | ctx) = (n(ctx c) + t(ctx) P_{k-1}(c)) / (n(ctx) + t(ctx)), where t counts the distinct
characters that followed the context. The other pages are judged by the difference of their log
likelihoods a character, against a threshold calibrated on the training pages.

Scale: urls are cut into n-grams once; both models are tables of distinct n-grams that grow with the
corpus. Counting combines map-side. A gram is scored once however often it occurs, and the join of
occurrences to scores has one row a gram on the model's side, so hot grams are split by skew handling.
Log ratios are rounded to integers, so sums don't depend on their order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

ORDER, SCALE, START = 4, 1_000_000, "\x02"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), *_LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, by host and path together, then by host, then first given; else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(reversed(rules), key=lambda r: (len(r.name), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(urls: DataFrame) -> DataFrame:
    """(key, class, gram): for each character of the text, it and the ORDER - 1 before it."""
    padded = F.concat(F.lit(START * (ORDER - 1)), F.col("lm_text"))
    return urls.where("lm_text <> ''").select("key", "class", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("lm_text")), lambda i: F.substring(padded, i, F.lit(ORDER)))).alias("gram"))


def gram_scores(grams: DataFrame) -> DataFrame:
    """(gram, ratio long): SCALE times the log likelihood ratio, accepted over rejected, of each distinct gram's last character."""
    count = lambda v: F.count(F.when(F.col("class") == v, 1))
    level = grams.groupBy("gram").agg(count("allow").alias("a"), count("block").alias("b"))
    tables = []  # by context length: n-gram and its context with counts
    for k in range(ORDER - 1, -1, -1):
        by = level if k == ORDER - 1 else level.groupBy(F.substring("gram", ORDER - k, k + 1).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        ctx = F.substring("gram", 1, k) if k else F.lit("")
        full = by.withColumn("ctx", ctx)
        kinds = full.groupBy("ctx").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count(F.when(F.col("a") > 0, 1)).alias("ta"), F.count(F.when(F.col("b") > 0, 1)).alias("tb"))
        tables.append((k, full.join(kinds, "ctx").drop("ctx")))
    tables.reverse()
    # characters that neither class has seen share one uniform share of 1/256
    scored = None
    for k, t in tables:
        prior = {"pa": F.lit(1 / 256), "pb": F.lit(1 / 256)}
        if scored is not None:
            lower = scored.select(F.col("gram").alias("low"), F.col("pa").alias("la"), F.col("pb").alias("lb"))
            t = t.withColumn("low", F.substring("gram", 2, k)).join(lower, "low")
            prior = {"pa": F.col("la"), "pb": F.col("lb")}
        mixed = {p: F.when(F.col(n) + F.col(d) > 0, (F.col(c) + F.col(d) * prior[p]) / (F.col(n) + F.col(d))).otherwise(prior[p]) for p, c, n, d in (("pa", "a", "na", "ta"), ("pb", "b", "nb", "tb"))}
        scored = t.withColumns(mixed).select("gram", "pa", "pb")
    return scored.select("gram", F.round((F.log("pa") - F.log("pb")) * SCALE).cast("long").alias("ratio"))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, *, url: str = "url") -> DataFrame:
    """pages plus host, path, rule, verdict and score (accepted over rejected, nats a character; null without host text).

    Null urls and urls without :// have an empty host and path, fit no rule, and are blocked, as is every page
    without text to judge. Where only one class or none has training pages the score still stands, and the
    threshold is 0. At the threshold: allow. Rows keep their other columns (those of these names are
    replaced); repeated rows stay repeated, and equal urls get equal verdicts.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    base = pages.select(keep).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    ruled = base.withColumn("__r", rule_of(F.col("host"), F.col("path"), rules))
    # one row for each url of the corpus: what is judged is all after ://
    text = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    urls = ruled.select(F.concat("host", F.substring(text, F.char_length("host") + 1, F.lit(2147483647))).alias("lm_text"), F.col("__r.verdict").alias("class"))
    urls = urls.where("lm_text <> ''").groupBy("lm_text", "class").agg(F.count("*").alias("n")).withColumn("key", F.xxhash64("lm_text"))
    grams = _grams(urls)
    scores = gram_scores(grams)
    sums = grams.join(scores, "gram").groupBy("key").agg(F.sum("ratio").alias("sum"), F.count("*").alias("chars"))
    each = sums.select("key", F.round(F.col("sum") / F.col("chars")).cast("long").alias("norm"))
    stats = each.join(urls, "key").agg(*[f.alias(n) for c, s in (("allow", "a"), ("block", "b")) for n, f in ((f"n{s}", F.count(F.when(F.col("class") == c, 1))), (f"s{s}", F.sum(F.when(F.col("class") == c, F.col("norm")))), (f"q{s}", F.sum(F.when(F.col("class") == c, F.col("norm").cast("decimal(20,0)") * F.col("norm")))))])
    mean = lambda s: F.col(f"s{s}") / F.col(f"n{s}")
    dev = lambda s: F.sqrt(F.greatest(F.lit(0.0), F.col(f"q{s}").cast("double") / F.col(f"n{s}") - mean(s) * mean(s))) + 1.0
    limit = stats.select(F.when((F.col("na") > 0) & (F.col("nb") > 0), (mean("a") * dev("b") + mean("b") * dev("a")) / (dev("a") + dev("b"))).otherwise(F.lit(0.0)).alias("__limit"))
    own = F.concat("host", F.substring(text, F.char_length("host") + 1, F.lit(2147483647)))
    keyed = ruled.withColumn("__key", F.when(own != "", F.xxhash64(own)))
    judged = keyed.join(each.withColumnsRenamed({"key": "__key", "norm": "__norm"}), "__key", "left").crossJoin(F.broadcast(limit))
    verdict = F.coalesce(F.col("__r.verdict"), F.when(F.col("__norm") >= F.col("__limit"), "allow").otherwise("block"))
    return judged.select(*keep, "host", "path", F.col("__r.rule").alias("rule"), verdict.alias("verdict"), (F.col("__norm") / SCALE).alias("score"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages. A null url has an empty host and path; repeated rows and null ids each give their row, an empty table none."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    """The same in SQL, one table for each order of the models."""
    upper, lower = _LOWER
    fit = lambda r: f"((host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}'))"
    longest = sorted(RULES, key=lambda r: (-len(r.name), -len(r.host)))
    pick = lambda what: "case " + " ".join(f"when {fit(r)} then '{getattr(r, what)}'" for r in longest) + " end"
    levels = []
    for k in range(ORDER):
        prior = {x: f"l.p{x}" if k else "1.0::double / 256" for x in "ab"}
        mixed = ", ".join(f"case when n{x} + t{x} > 0 then (c.{x} + t{x} * {prior[x]}) / (n{x} + t{x})::double else {prior[x]} end as p{x}" for x in "ab")
        levels.append(f"""c{k} as (select substr(gram, {ORDER - k}, {k + 1}) as g, sum(a)::bigint as a, sum(b)::bigint as b from counted group by 1),
k{k} as (select left(g, {k}) as ctx, sum(a)::bigint as na, sum(b)::bigint as nb, count(*) filter (a > 0) as ta, count(*) filter (b > 0) as tb from c{k} group by 1),
s{k} as (select c.g, {mixed} from c{k} c join k{k} on left(c.g, {k}) = ctx{f" join s{k - 1} l on l.g = substr(c.g, 2)" if k else ""})""")
    return f"""
with p as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}') as host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) as rest from pages),
r as (select *, host || substr(rest, length(host) + 1) as lm, {pick('name')} as rule, {pick('verdict')} as class from p),
u as (select distinct lm, class from r where lm <> ''),
x as (select lm, class, repeat(chr({ord(START)}), {ORDER - 1}) || lm as padded, unnest(range(1, length(lm) + 1)) as i from u),
grams as (select lm, class, substr(padded, i, {ORDER}) as gram from x),
counted as (select gram, count(*) filter (class = 'allow') as a, count(*) filter (class = 'block') as b from grams group by 1),
{', '.join(levels)},
each as (select lm, round(sum(round((ln(pa) - ln(pb)) * {SCALE})::bigint)::double / count(*))::bigint as norm from grams join s{ORDER - 1} on gram = g group by lm),
m as (select class, count(*) as n, avg(norm) as mean, sqrt(greatest(0.0, sum(norm::hugeint * norm)::double / count(*) - (sum(norm)::double / count(*)) ** 2)) + 1.0 as dev from each join u using (lm) where class is not null group by 1),
edge as (select coalesce((a.mean * b.dev + b.mean * a.dev) / (a.dev + b.dev), 0) as threshold from (select 1) left join m a on a.class = 'allow' left join m b on b.class = 'block')
select page_id, host, path, rule, coalesce(class, case when norm >= threshold then 'allow' else 'block' end) as verdict from r left join each using (lm), edge
"""


ORACLE = _oracle()
