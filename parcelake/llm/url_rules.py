"""URL verdicts: a rule list first, then association rules mined from the URLs it labels.

FP-growth (Spark ML, in the JVM) finds token combinations of labelled URLs that go with a verdict.
Rules below `MIN_SUPPORT` or `MIN_CONFIDENCE`, or no surer than a rule of some of their own tokens
are pruned; a rule may have any number of tokens. Each mined rule is posted under its rarest token; the
distinct URLs that no listed rule decides look their tokens up there. Tokens that stand in exactly the same
labelled URLs (the parameters of one template) are mined as one, and a URL with any of them has it: rules that
differ only in such tokens say the same equally surely, so verdicts are those of mining every token, without the
2^n combinations of n such tokens. The rule of the greatest
confidence wins, then of the greatest support, then block, then the first by tokens.

Tokens: host labels (h:), path segments (p:) and query keys (q:), runs of digits as #.

Results in special cases: a null url or one without :// has an empty host and path, no rule and the
default verdict; a url that no rule fits gets the default verdict; with no labelled urls nothing is
mined; repeated rows are judged alike; a null page_id is carried on.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

#: (rule, verdict): host and its subdomains, with paths that start like the rule's
LISTED = [("net/", "block"), ("example.net/en/", "allow"),
          ("example.com/de/", "block"), ("org/fr/", "allow")]
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a url; empty without ://."""
    rest = F.coalesce(F.expr("substring(url, locate('://', url) + 3)"), F.lit(""))
    rest = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, rest).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase,
                       string.ascii_lowercase)
    return (host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
            F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1))


def listed_rule(listed: list[tuple[str, str]]) -> Column:
    """The longest listed rule that fits the columns host and path, else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(listed, key=lambda r: (len(r[0]), r[0])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host)))
        found = F.when(fits & F.startswith("path", F.lit(slash + path)), rule).otherwise(found)
    return found


def tokens() -> Column:
    """Distinct tokens of the columns host, path and query."""
    def kind(prefix: str, column: str, split: str, change) -> Column:
        named = F.filter(F.split(column, split), lambda x: x != "")
        return F.transform(named, lambda x: F.concat(F.lit(prefix), change(x)))

    def digits(x: Column) -> Column:
        return F.regexp_replace(x, "[0-9]+", "#")

    return F.array_distinct(F.concat(
        kind("h:", "host", r"\.", digits), kind("p:", "path", "/", digits),
        kind("q:", "query", "&", lambda x: F.split_part(x, F.lit("="), F.lit(1)))))


def with_listed(pages: DataFrame, listed: list[tuple[str, str]]) -> DataFrame:
    """page_id, url, host, path, query, rule, listed (the rule's verdict) of every page."""
    host, path, query = parts(F.col("url"))
    verdict = F.lit(None).cast("string")
    for rule, says in listed:
        verdict = F.when(F.col("rule") == rule, says).otherwise(verdict)
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"),
                         path.alias("path"), query.alias("query"))
            .withColumn("rule", listed_rule(listed)).withColumn("listed", verdict))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """antecedent (sorted tokens), says, confidence, support, post (rarest token) of each mined rule;
    `labelled` has tokens and says."""
    label = F.concat(F.lit("="), "says")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(
        labelled.select(F.concat("tokens", F.array(label)).alias("items")))
    said = F.element_at("consequent", 1)
    rules = (model.associationRules
             .filter(F.startswith(said, F.lit("=")))
             .select(F.array_sort("antecedent").alias("antecedent"), F.substring(said, 2, 1 << 20).alias("says"),
                     "confidence", "support"))
    single = (model.freqItemsets.filter(F.size("items") == 1)
              .select(F.element_at("items", 1).alias("token"), "freq"))
    posted = (rules.withColumn("token", F.explode("antecedent")).join(single, "token")
              .groupBy("antecedent", "says", "confidence", "support")
              .agg(F.min(F.struct("freq", "token")).alias("rarest"))
              .select("antecedent", "says", "confidence", "support", F.col("rarest.token").alias("post")))
    shorter = posted.select(F.col("post").alias("token"), F.col("says").alias("same"),
                            F.col("antecedent").alias("part"), F.col("confidence").alias("sure"))
    beaten = (posted.select("antecedent", "says", "confidence", F.explode("antecedent").alias("token"))
              .join(shorter, "token")
              .filter((F.col("same") == F.col("says")) & (F.size("part") < F.size("antecedent"))
                      & (F.col("sure") >= F.col("confidence"))
                      & (F.size(F.array_except("part", "antecedent")) == 0))
              .select("antecedent", "says").distinct())
    return posted.join(beaten, ["antecedent", "says"], "left_anti")


def folds(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> Column:
    """A map from each token of enough labelled rows to the first of those in exactly the same rows.

    Rows of tokens are told apart by two 64-bit hashes, summed exactly. The map has at most
    (mean tokens of a row) / min_support entries, however many rows there are.
    """
    least = F.ceil(F.lit(min_support) * labelled.agg(F.count(F.lit(1))).scalar())
    sums = [F.sum(F.xxhash64(F.lit(seed), "tokens").cast("decimal(20,0)")).alias(f"in_{seed}") for seed in (1, 2)]
    alike = (labelled.select("tokens", F.explode("tokens").alias("token")).groupBy("token")
             .agg(F.count(F.lit(1)).alias("freq"), *sums).filter(F.col("freq") >= least)
             .groupBy("freq", "in_1", "in_2")
             .agg(F.min("token").alias("first"), F.collect_list("token").alias("same")))
    pairs = alike.select(F.explode("same").alias("token"), "first")
    return pairs.agg(F.map_from_entries(F.collect_list(F.struct("token", "first")))).scalar()


def folded(rows: DataFrame, firsts: Column) -> DataFrame:
    """`rows` with each of `tokens` replaced by what stands for it; tokens without it are in no rule."""
    named = F.transform("tokens", lambda t: F.element_at(F.col("_firsts"), t))
    return (rows.withColumn("_firsts", firsts)
            .withColumn("tokens", F.array_distinct(F.array_compact(named))).drop("_firsts"))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url and mined verdict of the urls (distinct, with tokens) that some rule fits."""
    candidates = (urls.withColumn("post", F.explode("tokens")).join(rules, "post")
                  .filter(F.size(F.array_except("antecedent", "tokens")) == 0))
    order = F.struct(-F.col("confidence"), -F.col("support"), F.col("says") != "block", "antecedent", "says")
    return candidates.groupBy("url").agg(F.min(order).alias("best")).select(
        "url", F.col("best.says").alias("mined"))


def judge(pages: DataFrame, listed: list[tuple[str, str]] | None = None, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    known = with_listed(pages, LISTED if listed is None else listed)
    labelled = known.filter(F.col("listed").isNotNull()).select(
        tokens().alias("tokens"), F.col("listed").alias("says"))
    firsts = folds(labelled, min_support)
    rules = mine(folded(labelled, firsts), min_support, min_confidence)
    open_urls = (known.filter(F.col("listed").isNull() & F.col("url").isNotNull())
                 .select("url", "host", "path", "query").distinct()
                 .select("url", tokens().alias("tokens")))
    return (known.join(match(folded(open_urls, firsts), rules), "url", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("listed", "mined", F.lit(DEFAULT)).alias("verdict")))


#: The same in SQL as far as rules of one and two tokens decide: all such combinations are counted.
ORACLE = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut),
known AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    list_distinct(list_concat(list_concat(
      [ 'h:' || regexp_replace(x, '[0-9]+', '#', 'g') FOR x IN string_split(host, '.') IF x <> '' ],
      [ 'p:' || regexp_replace(x, '[0-9]+', '#', 'g') FOR x IN string_split(path, '/') IF x <> '' ]),
      [ 'q:' || split_part(x, '=', 1) FOR x IN string_split(query, '&') IF x <> '' ])) AS tokens
  FROM parts),
judged AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS listed
  FROM known),
numbered AS (
  SELECT row_number() OVER () AS id, tokens, listed FROM judged WHERE listed IS NOT NULL),
least AS (SELECT ceil(0.01::DOUBLE * count(*)) AS least, count(*) AS total FROM numbered),
one AS (SELECT id, listed, unnest(tokens) AS token FROM numbered),
combos AS (
  SELECT id, listed, [token] AS antecedent FROM one
  UNION ALL
  SELECT a.id, a.listed, [a.token, b.token] FROM one a JOIN one b ON a.id = b.id AND a.token < b.token),
counts AS (SELECT antecedent, count(*) AS n FROM combos GROUP BY 1),
said AS (
  SELECT antecedent, listed AS says, count(*) AS n FROM combos GROUP BY 1, 2
  HAVING count(*) >= (SELECT least FROM least)),
rules AS (
  SELECT s.antecedent, s.says, s.n::DOUBLE / c.n AS confidence, s.n::DOUBLE / (SELECT total FROM least) AS support
  FROM said s JOIN counts c USING (antecedent) WHERE s.n::DOUBLE / c.n >= 0.8),
pruned AS (
  SELECT * FROM rules r WHERE len(antecedent) = 1 OR NOT EXISTS (
    SELECT 1 FROM rules q WHERE len(q.antecedent) = 1 AND q.says = r.says
      AND list_contains(r.antecedent, q.antecedent[1]) AND q.confidence >= r.confidence)),
open_urls AS (SELECT DISTINCT url, tokens FROM judged WHERE listed IS NULL AND url IS NOT NULL),
mined AS (
  SELECT url, says AS mined FROM (
    SELECT u.url, r.says, row_number() OVER (PARTITION BY u.url
      ORDER BY r.confidence DESC, r.support DESC, r.says <> 'block', r.antecedent, r.says) AS k
    FROM (SELECT url, tokens, unnest(tokens) AS token FROM open_urls) u
    JOIN pruned r ON r.antecedent[1] = u.token AND list_has_all(u.tokens, r.antecedent)) WHERE k = 1)
SELECT page_id, host, path, rule, coalesce(listed, mined, 'allow') AS verdict
FROM judged LEFT JOIN mined USING (url)
"""
