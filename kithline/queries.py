"""Registered linkage queries over a stand-in register made of ``pages``, and their DuckDB equivalents.

entity_id spreads pages over S1, S2 and S3 by page_id modulo 3; the name is a page's
whole title, the address its whole url, the country its language; records that show
the same document - the number in the last segment of the url - are matches.

Pairs are those of the default strategies and limits.  What a query uses more than
once - the preprocessed register, the pairs, the truth - is made once and stored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as txt
from .operators import blocking, candidates, decide, evaluate, features, labels, models, thresholds
from .operators.features import extract
from .plans.linker import Linker
from .schema import CAND, S1, SOURCE_COLUMNS, TRUTH_COLUMNS, Settings
from .sources import tsv
from .tables import new_path, stored

#: Fields of a page, as Java and RE2 patterns alike; an entity is what its url's last segment numbers.
TITLE, LANG, SHOWN = r"(?is)<title[^>]*>(.*?)</title>", r'(?i)<html[^>]*\slang="([^"]*)"', r"/([0-9]+)(/|\.html)?([?#].*)?$"


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    entity = F.concat(F.lit("S"), (1 + F.col("page_id") % 3).cast("string"), F.lit("-"), F.lpad(F.col("page_id").cast("string"), 7, "0"))
    shown = F.regexp_extract("url", SHOWN, 1).try_cast("bigint")
    return pages.select(entity.alias("entity_id"), F.regexp_extract("html", TITLE, 1).alias("business_name"), F.col("url").alias("business_address"), F.regexp_extract("html", LANG, 1).alias("country"), shown.alias("shown"))


def _of(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(F.substring("entity_id", 1, 2).isin(*names))


class Linkage:
    """The tables that a query is made of; each is made when it is first asked for, and stored."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def register(self) -> DataFrame:
        return stored(register(self.spark, self.sf_dir), "register")

    @cached_property
    def rows(self) -> DataFrame:
        return stored(txt.preprocess(self.register), "preprocessed")

    def of(self, *names: str) -> DataFrame:
        return _of(self.rows, *names)

    @property
    def sides(self) -> tuple[DataFrame, DataFrame]:
        """S1, and S2 with S3."""
        return self.of("S1"), self.of("S2", "S3")

    @property
    def ids(self) -> DataFrame:
        return candidates.s1_ids(_of(self.register, "S1"))

    @cached_property
    def candidates(self) -> DataFrame:
        """A list for each S1 record; pairs are made where they are used."""
        return stored(candidates.generate_lists(self.of("S1"), self.of("S2"), self.of("S3")), "candidates")

    @property
    def pairs(self) -> DataFrame:
        return candidates.as_pairs(self.candidates)

    @cached_property
    def truth(self) -> DataFrame:
        one, other = _of(self.register, "S1").select(F.col("entity_id").alias(S1), "shown"), _of(self.register, "S2", "S3").select(F.col("entity_id").alias(CAND), "shown")
        groups = candidates.grouped(one.join(other, "shown").select(S1, CAND), out="matched_entity_ids")
        return stored(candidates.with_all_ids(groups, one, "matched_entity_ids"), "truth")

    def features(self, names: list[str]) -> DataFrame:
        found = extract(self.candidates, *self.sides, only=names)
        return found.select(S1, CAND, *[F.round(n, 6).alias(n) for n in names])

    def scored(self) -> DataFrame:
        """Labelled pairs with a deterministic score."""
        return extract(self.candidates, *self.sides, only=["name_jaccard"], truth=self.truth).withColumnRenamed("name_jaccard", "probability")

    @cached_property
    def results(self) -> DataFrame:
        scored = thresholds.apply_threshold(self.scored(), 0.5)
        return stored(decide.match_output(scored, self.ids, _of(self.register, "S2", "S3").select(F.col("entity_id").alias(CAND)), self.candidates), "results")


def normalize_name(spark, sf_dir):
    return register(spark, sf_dir).select("entity_id", txt.normalize_name(F.col("business_name")).alias("name"))


def normalize_address(spark, sf_dir):
    return register(spark, sf_dir).select("entity_id", txt.normalize_address(F.col("business_address")).alias("address"))


def normalize_country(spark, sf_dir):
    return register(spark, sf_dir).select("entity_id", txt.normalize_country(F.col("country")).alias("country"))


def tokens(spark, sf_dir):
    rows = txt.preprocess_all(*(_of(register(spark, sf_dir), f"S{k}") for k in (1, 2, 3)))
    joined = lambda c: F.array_join(c, " ")
    in_order = lambda c: joined(F.array_sort(txt.token_set(F.col(c))))
    return reduce(DataFrame.unionByName, rows).select("entity_id", joined("name_tokens").alias("name_tokens"), joined("address_tokens").alias("address_tokens"), in_order("business_name_normalized").alias("name_token_set"), in_order("business_address_normalized").alias("address_token_set"))


def ascii_safe(spark, sf_dir):
    return register(spark, sf_dir).select("entity_id", txt.to_ascii_safe(F.col("business_name")).alias("name"))


def block_exact_name(spark, sf_dir):
    return blocking.exact_name(*Linkage(spark, sf_dir).sides)


def block_token_name(spark, sf_dir):
    return blocking.token_name(*Linkage(spark, sf_dir).sides)


def block_token_name_2(spark, sf_dir):
    return blocking.token_name(*Linkage(spark, sf_dir).sides, min_shared=2)


def block_token_address(spark, sf_dir):
    return blocking.token_address(*Linkage(spark, sf_dir).sides)


def block_country_aware(spark, sf_dir):
    return blocking.country_aware(*Linkage(spark, sf_dir).sides)


def block_country_exact(spark, sf_dir):
    return blocking.country_aware(*Linkage(spark, sf_dir).sides, inner="exact_name")


def block_tfidf_topk(spark, sf_dir):
    return blocking.tfidf_scores(*Linkage(spark, sf_dir).sides).select(S1, CAND, F.round("score", 6).alias("score"))


def block_tfidf_kernel(spark, sf_dir):
    """The same by blocks, whatever the size."""
    return blocking.tfidf_scores(*Linkage(spark, sf_dir).sides, kernel=True).select(S1, CAND, F.round("score", 6).alias("score"))


def candidates_capped(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return candidates.generate(own.of("S1"), own.of("S2"), own.of("S3"), settings=Settings(max_candidates=5))


def candidates_grouped(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return candidates.with_all_ids(candidates.grouped(own.candidates), own.ids)


def candidates_by_pool(spark, sf_dir):
    """Lists turned around: the S1 records of each candidate."""
    own = Linkage(spark, sf_dir)
    return candidates.by_candidate(own.candidates, own.of("S2", "S3").select(F.col("entity_id").alias(CAND)), "source1_entity_ids")


def strategy_contributions(spark, sf_dir):
    return blocking.contributions(*Linkage(spark, sf_dir).sides, list(Settings().strategies))


def sim_jaccard(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["name_jaccard", "addr_jaccard", "name_exact_match"])


def sim_overlap(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["name_token_overlap_s1", "name_token_overlap_cand", "addr_token_overlap_s1", "addr_token_overlap_cand"])


def sim_ngram(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["name_trigram_overlap", "name_bigram_overlap", "addr_trigram_overlap"])


def len_diffs(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["name_len_diff", "name_token_count_diff", "addr_len_diff"])


def missing_flags(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["country_exact_match", *features.FEATURES[18:]])


def sim_edit(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["name_edit_similarity", "addr_edit_similarity"])


def sim_partial(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["name_partial_ratio"])


def sim_token_sort(spark, sf_dir):
    return Linkage(spark, sf_dir).features(["name_token_sort_ratio"])


def feature_matrix(spark, sf_dir):
    return Linkage(spark, sf_dir).features(features.feature_names())


def sim_tfidf_cosine(spark, sf_dir):
    found = features.tfidf_cosine(Linkage(spark, sf_dir).rows, "business_name_normalized", "business_address_normalized", "entity_id")
    return found.select("entity_id", F.round("cosine", 6).alias("cosine"))


def pair_labels(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return labels.label_pairs(own.pairs, own.truth)


def truth_lists(spark, sf_dir):
    return Linkage(spark, sf_dir).truth


def candidate_recall(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return evaluate.candidate_recall(own.candidates, own.truth).withColumn("candidate_recall", F.round("candidate_recall", 6))


def split_members(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return labels.split_members(_of(own.register, "S1"), own.truth)


def split_tables(spark, sf_dir):
    """The parts that a split makes of the records and of the truth."""
    own = Linkage(spark, sf_dir)
    parts = labels.create_split(_of(own.register, "S1"), own.truth)
    named = {"s1_train": parts.s1_train, "s1_val": parts.s1_val, "truth_train": parts.truth_train.withColumnRenamed(S1, "entity_id"), "truth_val": parts.truth_val.withColumnRenamed(S1, "entity_id")}
    return reduce(DataFrame.unionByName, [df.select("entity_id", F.lit(n).alias("part")) for n, df in named.items()])


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c).cast("long").alias(c) if k in ("int", "bigint") else F.col(c) for c, k in df.dtypes])


def pair_metrics(spark, sf_dir):
    return _rounded(thresholds.pair_metrics(thresholds.apply_threshold(Linkage(spark, sf_dir).scored(), 0.5)))


def threshold_sweep(spark, sf_dir):
    return _rounded(thresholds.sweep(Linkage(spark, sf_dir).scored()))


def positive_pairs(spark, sf_dir):
    """Pairs that reach the threshold that the search finds best, with that threshold."""
    scored = stored(Linkage(spark, sf_dir).scored(), "scored")
    best, _ = thresholds.tune(scored)
    found = thresholds.positive_pairs(thresholds.apply_threshold(scored, best))
    return found.select(S1, CAND, F.round("probability", 6).alias("probability"), F.lit(round(best, 6)).alias("threshold"))


def match_output(spark, sf_dir):
    return Linkage(spark, sf_dir).results


def validate_output(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return decide.violations(own.results, own.ids, candidates.with_all_ids(candidates.grouped(own.candidates), own.ids))


def macro_f05(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return _rounded(evaluate.macro_f05(own.results, own.truth))


def eval_report(spark, sf_dir):
    own = Linkage(spark, sf_dir)
    return _rounded(evaluate.full_report(own.results, own.truth, own.candidates))


def scan_checks(spark, sf_dir):
    rows = register(spark, sf_dir)
    return tsv.id_report(_of(rows, "S1"), "S1-").join(tsv.missing_counts(rows.select("business_name", "business_address", "country")))


def _files(own: Linkage) -> dict[str, str]:
    """The register and the truth as TSV files in the shared folder."""
    at = new_path(own.spark, "register-tsv")
    parts = {f"s{k}": (_of(own.register, f"S{k}"), SOURCE_COLUMNS) for k in (1, 2, 3)} | {"truth": (own.truth, TRUTH_COLUMNS)}
    for name, (df, columns) in parts.items():
        tsv.write_tsv(df, f"{at}/{name}.tsv", columns)
    return {name: tsv.find_file(own.spark, f"{at}/{name}.tsv", f"{at}/none.tsv") for name in parts}


def source_files(spark, sf_dir):
    """The three sources written as TSV files, loaded and validated."""
    files = _files(Linkage(spark, sf_dir))
    return reduce(DataFrame.unionByName, tsv.load_test_data(spark, files["s1"], files["s2"], files["s3"]))


def truth_files(spark, sf_dir):
    """The ground truth written as a TSV file and loaded with the sources, with each S1 record's name."""
    files = _files(Linkage(spark, sf_dir))
    one, _, _, truth = tsv.load_train_data(spark, files["s1"], files["s2"], files["s3"], files["truth"])
    return truth.join(one.select(F.col("entity_id").alias(S1), "business_name"), S1)


def result_files(spark, sf_dir):
    """Results and candidates written as the two result files, and read back."""
    own = Linkage(spark, sf_dir)
    at = new_path(spark, "results-tsv")
    tsv.write_matching_results(own.results, f"{at}/results.tsv")
    tsv.write_candidate_pairs(candidates.with_all_ids(candidates.grouped(own.candidates), own.ids), f"{at}/candidates.tsv", single=False)
    found = tsv.read_tsv(spark, f"{at}/results.tsv", [S1, "matched_entity_ids"])
    return found.join(tsv.read_tsv(spark, f"{at}/candidates.tsv", [S1, "candidate_entity_ids"], multi_line=False), S1)


def threshold_file(spark, sf_dir):
    """A threshold stored as JSON and loaded, and the default where there is none."""
    at = new_path(spark, "threshold")
    tsv.save_threshold(spark, 0.725, f"{at}/threshold.json")
    return spark.createDataFrame([(tsv.load_threshold(spark, f"{at}/threshold.json"), tsv.load_threshold(spark, f"{at}/none.json", 0.5))], "stored double, absent double")


def predicted_matches(spark, sf_dir):
    """Match lists of a whole prediction: a stored model, here one whose probability is the names' similarity, loaded and applied."""
    own, at = Linkage(spark, sf_dir), new_path(spark, "model")
    given = SQLTransformer(statement="SELECT *, 1 - name_jaccard AS apart, name_jaccard AS alike FROM __THIS__")
    models.save_model(PipelineModel([given, VectorAssembler(inputCols=["apart", "alike"], outputCol="probability_vector")]), at)
    linker = Linker(spark, Settings(), models.load_model(spark, at), 0.5)
    return linker.predict(*(_of(own.register, f"S{k}") for k in (1, 2, 3))).results


def _fitted(own: Linkage, kind: str, **options) -> DataFrame:
    labelled = stored(labels.label_pairs(extract(own.pairs, *own.sides), own.truth), "labelled")
    model = models.train(labelled, kind, Settings(model_options=options))
    return models.predict_probability(model, labelled).select(S1, CAND, F.round("probability", 6).alias("probability"))


def score_lr(spark, sf_dir):
    return _fitted(Linkage(spark, sf_dir), "logistic_regression")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        candidates_grouped, normalize_name, normalize_address, normalize_country, tokens, ascii_safe, block_exact_name, block_token_name, block_token_name_2, block_token_address,
        block_country_aware, block_country_exact, block_tfidf_topk, block_tfidf_kernel, candidates_capped, candidates_by_pool, strategy_contributions, sim_jaccard, sim_overlap, sim_ngram, len_diffs,
        missing_flags, sim_edit, sim_partial, sim_token_sort, feature_matrix, sim_tfidf_cosine, pair_labels, truth_lists, candidate_recall, split_members, split_tables, pair_metrics,
        threshold_sweep, positive_pairs, match_output, validate_output, macro_f05, eval_report, scan_checks, source_files, truth_files, result_files, threshold_file, predicted_matches, score_lr,
    ]
    return {f.__name__: f for f in own}


# --- The same in DuckDB ---------------------------------------------------------------------------------------

_WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _strip(e: str) -> str:
    return f"regexp_replace({e}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _normal(column: str, rules: list[tuple[str, str]]) -> str:
    e = f"lower({_strip(f'''nfc_normalize(coalesce({column}, ''))''')})"
    tidy = lambda x: f"trim(regexp_replace({x}, '[{_WS}]+', ' ', 'g'))"
    e = tidy(rf"regexp_replace({e}, '[^\pL\pN_&/\-{_WS}]', ' ', 'g')")
    for words, to in rules:
        for _ in range(2):  # neighbours share the character between them
            e = rf"regexp_replace({e}, '(^|[^\pL\pN_])(?:{words})($|[^\pL\pN_])', '\1{to}\2', 'g')"
    return tidy(e)


_BASE = f"""
src AS MATERIALIZED (
  SELECT 'S' || CAST(1 + page_id % 3 AS VARCHAR) || '-' || lpad(CAST(page_id AS VARCHAR), 7, '0') AS entity_id,
    regexp_extract(html, '{TITLE}', 1) AS business_name, url AS business_address, regexp_extract(html, '{LANG}', 1) AS country, TRY_CAST(regexp_extract(url, '{SHOWN}', 1) AS BIGINT) AS shown
  FROM pages
), norm AS MATERIALIZED (
  SELECT entity_id, shown, {_normal("business_name", txt.NAME_RULES)} AS nm, {_normal("business_address", txt.ADDRESS_RULES)} AS ad, lower({_strip("coalesce(country, '')")}) AS ct
  FROM src
), toks AS MATERIALIZED (
  SELECT *, [t FOR t IN string_split(nm, ' ') IF length(t) >= 2] AS nt, [t FOR t IN string_split(ad, ' ') IF length(t) >= 2] AS adt FROM norm
), one AS (SELECT * FROM toks WHERE entity_id LIKE 'S1%'), pool AS (SELECT * FROM toks WHERE entity_id NOT LIKE 'S1%'),
n1 AS (SELECT entity_id AS s, ct, unnest(nt) AS token FROM one), n2 AS (SELECT entity_id AS c, ct, unnest(nt) AS token FROM pool),
a1 AS (SELECT entity_id AS s, unnest(adt) AS token FROM one), a2 AS (SELECT entity_id AS c, unnest(adt) AS token FROM pool),
exact_pairs AS (SELECT DISTINCT o.entity_id AS s, p.entity_id AS c FROM one o JOIN pool p ON o.nm = p.nm WHERE o.nm <> ''),
name_pairs AS (SELECT DISTINCT s, c FROM n1 JOIN n2 USING (token) WHERE length(token) >= 3),
address_pairs AS (SELECT s, c FROM a1 JOIN a2 USING (token) WHERE length(token) >= 3 GROUP BY s, c HAVING count(*) >= 2),
gram_words AS (SELECT entity_id AS id, ' ' || w || ' ' AS p FROM (SELECT entity_id, unnest(string_split(lower(nm), ' ')) AS w FROM toks) WHERE w <> ''),
name_grams AS (
  SELECT id, unnest([substr(p, CAST(i AS BIGINT), 2) FOR i IN generate_series(1, length(p) - 1)]) AS gram FROM gram_words
  UNION ALL SELECT id, unnest([substr(p, CAST(i AS BIGINT), 3) FOR i IN generate_series(1, length(p) - 2)]) FROM gram_words),
name_tf AS (SELECT id, gram, count(*) AS tf FROM name_grams GROUP BY 1, 2), name_df AS (SELECT gram, count(*) AS df FROM name_tf GROUP BY 1 HAVING count(*) >= 2),
name_weights AS MATERIALIZED (SELECT id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM (
  SELECT id, name_tf.gram, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM toks)) / (1.0 + df)) + 1) AS w FROM name_tf JOIN name_df USING (gram))),
gram_scores AS (SELECT a.id AS s, b.id AS c, round(sum(a.weight * b.weight), 9) AS score FROM name_weights a JOIN name_weights b USING (gram) WHERE a.id LIKE 'S1%' AND b.id NOT LIKE 'S1%' GROUP BY 1, 2),
gram_pairs AS MATERIALIZED (SELECT s, c, score FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY score DESC, c) AS k FROM gram_scores WHERE score > 0) WHERE k <= 10),
all_prs AS MATERIALIZED (SELECT s, c, min(k) AS k FROM (
  SELECT s, c, 1 AS k FROM exact_pairs UNION ALL SELECT s, c, 2 FROM name_pairs UNION ALL SELECT s, c, 3 FROM gram_pairs UNION ALL SELECT s, c, 4 FROM address_pairs) GROUP BY 1, 2),
prs AS MATERIALIZED (SELECT s, c FROM (SELECT s, c, row_number() OVER (PARTITION BY s ORDER BY c) AS k FROM all_prs) WHERE k <= 500),
truth_pairs AS (SELECT o.entity_id AS s, p.entity_id AS c FROM one o JOIN pool p USING (shown)),
truth AS (SELECT o.entity_id AS s, coalesce(string_agg(DISTINCT t.c, ',' ORDER BY t.c), '') AS ids FROM one o LEFT JOIN truth_pairs t ON o.entity_id = t.s GROUP BY 1),
wide AS (
  SELECT prs.s, prs.c, o.nm AS x, p.nm AS y, o.ad AS ax, p.ad AS ay, o.ct AS cx, p.ct AS cy,
    [t FOR t IN string_split(o.nm, ' ') IF t <> ''] AS xt, [t FOR t IN string_split(p.nm, ' ') IF t <> ''] AS yt,
    [t FOR t IN string_split(o.ad, ' ') IF t <> ''] AS axt, [t FOR t IN string_split(p.ad, ' ') IF t <> ''] AS ayt
  FROM prs JOIN one o ON o.entity_id = prs.s JOIN pool p ON p.entity_id = prs.c
)"""
_IDS = "s AS source1_entity_id, c AS candidate_entity_id"


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE 0.0 END"


def _guard(a: str, b: str, value: str) -> str:
    return f"round(CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE CAST({value} AS DOUBLE) END, 6)"


def _jaccard(a: str, b: str, x: str, y: str) -> str:
    return _guard(a, b, _share(f"len(list_intersect({x}, {y}))", f"len(list_distinct(list_concat({x}, {y})))"))


def _overlap(a: str, b: str, x: str, y: str) -> str:
    return _guard(a, b, _share(f"len(list_intersect({x}, {y}))", f"len(list_distinct({x}))"))


def _grams(a: str, b: str, n: int) -> str:
    g = lambda s: f"list_distinct([substr({s}, CAST(i AS BIGINT), {n}) FOR i IN generate_series(1, length({s}) - {n - 1})])"
    x, y = g(a), g(b)
    return f"round(CASE WHEN len({x}) = 0 AND len({y}) = 0 THEN 1.0 WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE CAST({_share(f'len(list_intersect({x}, {y}))', f'len(list_distinct(list_concat({x}, {y})))')} AS DOUBLE) END, 6)"


def _apart(x: str, y: str) -> str:
    return f"round(CAST(abs({x} - {y}) AS DOUBLE) / (greatest({x}, {y}) + 1), 6)"


def _masks(a: str, b: str) -> str:
    """For every character of b where it stands in a, as bits (of strings of at most 120 characters)."""
    return f"[coalesce(list_sum([CAST(1 AS HUGEINT) << CAST(i AS INTEGER) FOR i IN range(length({a})) IF {a}[CAST(i + 1 AS BIGINT)] = q]), 0)::HUGEINT FOR q IN string_split({b}, '')]"


def _lcs(n: str, masks: str) -> str:
    """Longest common subsequence from the masks of the other string in a string of n characters: one carry-propagating step a character."""
    full = f"((CAST(1 AS HUGEINT) << CAST({n} AS INTEGER)) - 1)"
    return f"({n} - bit_count(list_reduce({masks}, lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}, {full})))"


def _edit(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE CAST(2.0 * {_lcs(f'length({a})', _masks(a, b))} AS DOUBLE) / (length({a}) + length({b})) END"


def _partial(a: str, b: str) -> str:
    """Best edit ratio of a and the windows of b, which is not shorter, of a's length or cut at an end."""
    m, n = f"length({a})", f"length({b})"
    of = lambda begin, end: _lcs(m, f"({_masks(a, b)})[{begin}:{end}]")
    ratio = lambda i, k: f"list_max([CAST(2.0 * {of(i[0], i[1])} AS DOUBLE) / ({m} + {i[2]}) FOR i IN {k}])"
    heads, whole, tails = ratio(("1", "i", "i"), f"range(1, {m})"), ratio(("i", f"i + {m} - 1", m), f"range(1, {n} - {m} + 2)"), ratio((f"{n} - i + 1", n, "i"), f"range(1, {m})")
    return f"greatest(coalesce({heads}, 0), coalesce({whole}, 0), coalesce({tails}, 0))"


def _flag(c: str) -> str:
    return f"CAST(CASE WHEN {c} THEN 1.0 ELSE 0.0 END AS DOUBLE)"


_RATES = """CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  round(p, 6) AS "precision", round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1,
  round(CASE WHEN 0.25 * p + r > 0 THEN 1.25 * p * r / (CAST(0.25 AS DOUBLE) * p + r) ELSE 0 END, 6) AS f0_5
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE CAST(0 AS DOUBLE) END AS p, CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE CAST(0 AS DOUBLE) END AS r FROM counts)"""
_SCORED = f""", scored AS (
  SELECT w.s, w.c, CAST({_share("len(list_intersect(xt, yt))", "len(list_distinct(list_concat(xt, yt)))")} AS DOUBLE) AS raw, x, y, t.s IS NOT NULL AS label
  FROM wide w LEFT JOIN (SELECT DISTINCT s, c FROM truth_pairs) t ON t.s = w.s AND t.c = w.c
), graded AS (SELECT s, c, label, CASE WHEN x = '' AND y = '' THEN 1.0 WHEN x = '' OR y = '' THEN 0.0 ELSE raw END AS probability FROM scored),
results AS (
  SELECT o.entity_id AS s, coalesce(string_agg(g.c, ',' ORDER BY g.c), '') AS ids, coalesce(list(g.c) FILTER (WHERE g.c IS NOT NULL), []) AS pred FROM one o
  LEFT JOIN (SELECT s, c FROM graded WHERE probability >= 0.5) g ON g.s = o.entity_id GROUP BY 1
), each AS (
  SELECT s, pred, coalesce(tl, []) AS tru FROM results LEFT JOIN (SELECT s, list(DISTINCT c) AS tl FROM truth_pairs GROUP BY s) t USING (s)
), rated AS (
  SELECT *, CASE WHEN len(pred) = 0 AND len(tru) = 0 THEN 1.0 WHEN len(pred) = 0 OR len(tru) = 0 THEN 0.0 ELSE CAST(len(list_intersect(pred, tru)) AS DOUBLE) / len(pred) END AS p,
    CASE WHEN len(tru) = 0 THEN 1.0 WHEN len(pred) = 0 THEN 0.0 ELSE CAST(len(list_intersect(pred, tru)) AS DOUBLE) / len(tru) END AS r FROM each
), judged AS (SELECT *, CASE WHEN len(pred) = 0 AND len(tru) = 0 THEN CAST(1.0 AS DOUBLE) WHEN 0.25 * p + r > 0 THEN CAST(1.25 * p * r / (0.25 * p + r) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS f FROM rated)"""
_MACRO = """round(avg(f), 6) AS macro_f0_5, round(avg(CAST(p AS DOUBLE)), 6) AS macro_precision, round(avg(CAST(r AS DOUBLE)), 6) AS macro_recall, count(*) AS n_entities,
  count(*) FILTER (WHERE len(tru) = 0) AS n_singletons_total, count(*) FILTER (WHERE len(tru) = 0 AND len(pred) = 0) AS n_singletons_correct, count(*) FILTER (WHERE len(tru) > 0) AS n_with_matches_total"""
_WEIGHTS = """SELECT {key}, gram, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM (
  SELECT {key}, tf.gram, (1 + ln(tf)) * (ln((1.0 + n) / (1.0 + df)) + 1) AS w FROM tf JOIN dfs USING (gram), total)"""


def oracle_sql() -> dict[str, str]:
    with_base = lambda select, more="": f"WITH {_BASE}{more} {select}"
    capped = f"SELECT {_IDS}, substr(c, 1, 2) AS candidate_source FROM (SELECT s, c, row_number() OVER (PARTITION BY s ORDER BY c) AS k FROM all_prs)"
    topk = f"SELECT {_IDS}, round(score, 6) AS score FROM gram_pairs"
    partial = f"""SELECT x, y, round(CASE WHEN x = '' OR y = '' THEN CASE WHEN x = y THEN 1.0 ELSE 0.0 END WHEN contains(x, y) OR contains(y, x) THEN 1.0 WHEN length(x) < length(y) THEN {_partial("x", "y")}
      WHEN length(y) < length(x) THEN {_partial("y", "x")} ELSE greatest({_partial("x", "y")}, {_partial("y", "x")}) END, 6) AS name_partial_ratio FROM (SELECT DISTINCT x, y FROM wide)"""
    made = {
        "name_exact_match": _flag("x = y AND x <> ''"), "name_jaccard": _jaccard("x", "y", "xt", "yt"), "name_token_overlap_s1": _overlap("x", "y", "xt", "yt"), "name_token_overlap_cand": _overlap("y", "x", "yt", "xt"),
        "name_edit_similarity": f"round({_edit('x', 'y')}, 6)", "name_partial_ratio": "name_partial_ratio",
        "name_token_sort_ratio": f"(SELECT round({_edit('p', 'q')}, 6) FROM (SELECT array_to_string(list_sort(xt), ' ') AS p, array_to_string(list_sort(yt), ' ') AS q))",
        "name_trigram_overlap": _grams("x", "y", 3), "name_bigram_overlap": _grams("x", "y", 2), "name_len_diff": _apart("length(x)", "length(y)"), "name_token_count_diff": _apart("len(xt)", "len(yt)"),
        "addr_jaccard": _jaccard("ax", "ay", "axt", "ayt"), "addr_token_overlap_s1": _overlap("ax", "ay", "axt", "ayt"), "addr_token_overlap_cand": _overlap("ay", "ax", "ayt", "axt"), "addr_edit_similarity": f"round({_edit('ax', 'ay')}, 6)",
        "addr_trigram_overlap": _grams("ax", "ay", 3), "addr_len_diff": _apart("length(ax)", "length(ay)"), "country_exact_match": _flag("cx = cy AND cx <> ''"),
        "s1_name_missing": _flag("x = ''"), "cand_name_missing": _flag("y = ''"), "s1_addr_missing": _flag("ax = ''"), "cand_addr_missing": _flag("ay = ''"), "s1_country_missing": _flag("cx = ''"), "cand_country_missing": _flag("cy = ''"), "is_s2": _flag("c LIKE 'S2-%'"),
    }
    several = lambda names: with_base(f"SELECT {_IDS}, " + ", ".join(f"{made[n]} AS {n}" for n in names) + " FROM wide" + (f" JOIN ({partial}) USING (x, y)" if "name_partial_ratio" in names else ""))
    cosine = """, words AS (
        SELECT 'a' || entity_id AS k, regexp_extract_all(lower(nm), '[\\pL\\pN_]{2,}') AS ws FROM toks UNION ALL SELECT 'b' || entity_id, regexp_extract_all(lower(ad), '[\\pL\\pN_]{2,}') FROM toks),
      grams AS (SELECT k, unnest(ws) AS gram FROM words UNION ALL SELECT k, unnest([ws[CAST(i AS BIGINT)] || ' ' || ws[CAST(i AS BIGINT) + 1] FOR i IN generate_series(1, len(ws) - 1)]) FROM words),
      best AS (SELECT gram FROM grams GROUP BY gram ORDER BY count(*) DESC, gram LIMIT 10000),
      tf AS (SELECT k, gram, count(*) AS tf FROM grams WHERE gram IN (SELECT gram FROM best) GROUP BY 1, 2), dfs AS (SELECT gram, count(*) AS df FROM tf GROUP BY 1), total AS (SELECT 2 * count(*) AS n FROM toks),
      weights AS MATERIALIZED (""" + _WEIGHTS.format(key="k") + """),
      dots AS (SELECT substr(a.k, 2) AS entity_id, sum(a.weight * b.weight) AS dot FROM weights a JOIN weights b ON a.gram = b.gram AND a.k = 'a' || substr(b.k, 2) WHERE b.k LIKE 'b%' GROUP BY 1)"""
    grid = ", ".join(f"CAST('{t!r}' AS DOUBLE)" for t in thresholds.grid(Settings()))
    sweep = f""", counts AS (
        SELECT threshold, count(*) FILTER (WHERE label AND probability >= threshold) AS tp, count(*) FILTER (WHERE NOT label AND probability >= threshold) AS fp,
          count(*) FILTER (WHERE label AND NOT probability >= threshold) AS fn, count(*) FILTER (WHERE NOT label AND NOT probability >= threshold) AS tn
        FROM graded, (SELECT unnest([{grid}]) AS threshold) GROUP BY threshold)"""
    at_half = """, counts AS (SELECT count(*) FILTER (WHERE label AND probability >= 0.5) AS tp, count(*) FILTER (WHERE NOT label AND probability >= 0.5) AS fp,
        count(*) FILTER (WHERE label AND NOT probability >= 0.5) AS fn, count(*) FILTER (WHERE NOT label AND NOT probability >= 0.5) AS tn FROM graded)"""
    recall = """(SELECT count(*) AS n_true, count(p.s) AS n_covered FROM truth_pairs t LEFT JOIN prs p ON p.s = t.s AND p.c = t.c)"""
    return {
        "normalize_name": with_base("SELECT entity_id, nm AS name FROM norm"),
        "normalize_address": with_base("SELECT entity_id, ad AS address FROM norm"),
        "normalize_country": with_base("SELECT entity_id, ct AS country FROM norm"),
        "tokens": with_base("""SELECT entity_id, array_to_string(nt, ' ') AS name_tokens, array_to_string(adt, ' ') AS address_tokens, array_to_string(list_sort(list_distinct([t FOR t IN nt IF length(t) >= 3])), ' ') AS name_token_set,
            array_to_string(list_sort(list_distinct([t FOR t IN adt IF length(t) >= 3])), ' ') AS address_token_set FROM toks"""),
        "ascii_safe": with_base(r"SELECT entity_id, regexp_replace(strip_accents(coalesce(business_name, '')), '[^\x00-\x7F]', '', 'g') AS name FROM src"),
        "block_exact_name": with_base(f"SELECT {_IDS} FROM exact_pairs"),
        "block_token_name": with_base(f"SELECT DISTINCT {_IDS} FROM n1 JOIN n2 USING (token) WHERE length(token) >= 3"),
        "block_token_name_2": with_base(f"SELECT {_IDS} FROM n1 JOIN n2 USING (token) WHERE length(token) >= 3 GROUP BY s, c HAVING count(*) >= 2"),
        "block_token_address": with_base(f"SELECT {_IDS} FROM address_pairs"),
        "block_country_aware": with_base(f"SELECT DISTINCT {_IDS} FROM n1 JOIN n2 USING (token) WHERE length(token) >= 3 AND (n1.ct = n2.ct OR n1.ct = '')"),
        "block_country_exact": with_base("SELECT DISTINCT o.entity_id AS source1_entity_id, p.entity_id AS candidate_entity_id FROM one o JOIN pool p ON o.nm = p.nm WHERE o.nm <> '' AND (o.ct = p.ct OR o.ct = '')"),
        "block_tfidf_topk": with_base(topk),
        "block_tfidf_kernel": with_base(topk),
        "candidates_capped": with_base(capped + " WHERE k <= 5"),
        "candidates_grouped": with_base(f"SELECT o.entity_id AS source1_entity_id, coalesce(string_agg(q.candidate_entity_id, ',' ORDER BY q.candidate_entity_id), '') AS candidate_entity_ids FROM one o LEFT JOIN ({capped} WHERE k <= 500) q ON q.source1_entity_id = o.entity_id GROUP BY 1"),
        "strategy_contributions": with_base("SELECT strategy, count(*) AS new_pairs FROM all_prs JOIN (VALUES (1, 'exact_name'), (2, 'token_name'), (3, 'tfidf_name'), (4, 'token_address')) v(k, strategy) USING (k) GROUP BY 1"),
        "candidates_by_pool": with_base("SELECT p.entity_id AS candidate_entity_id, coalesce(string_agg(q.s, ',' ORDER BY q.s), '') AS source1_entity_ids FROM pool p LEFT JOIN prs q ON q.c = p.entity_id GROUP BY 1"),
        "sim_jaccard": several(["name_jaccard", "addr_jaccard", "name_exact_match"]),
        "sim_overlap": several(["name_token_overlap_s1", "name_token_overlap_cand", "addr_token_overlap_s1", "addr_token_overlap_cand"]),
        "sim_ngram": several(["name_trigram_overlap", "name_bigram_overlap", "addr_trigram_overlap"]),
        "len_diffs": several(["name_len_diff", "name_token_count_diff", "addr_len_diff"]),
        "missing_flags": several(["country_exact_match", *features.FEATURES[18:]]),
        "sim_edit": several(["name_edit_similarity", "addr_edit_similarity"]),
        "sim_partial": several(["name_partial_ratio"]),
        "sim_token_sort": several(["name_token_sort_ratio"]),
        "feature_matrix": several(features.FEATURES),
        "sim_tfidf_cosine": with_base("SELECT entity_id, round(coalesce(dot, 0), 6) AS cosine FROM toks LEFT JOIN dots USING (entity_id)", cosine),
        "pair_labels": with_base(f"SELECT DISTINCT prs.s AS source1_entity_id, prs.c AS candidate_entity_id, CASE WHEN t.s IS NULL THEN 0 ELSE 1 END AS label FROM prs LEFT JOIN truth_pairs t ON t.s = prs.s AND t.c = prs.c"),
        "truth_lists": with_base("SELECT s AS source1_entity_id, ids AS matched_entity_ids FROM truth"),
        "candidate_recall": with_base(f"SELECT n_true, n_covered, round(CASE WHEN n_true > 0 THEN CAST(n_covered AS DOUBLE) / n_true ELSE 0 END, 6) AS candidate_recall FROM {recall}"),
        "split_members": with_base("""SELECT entity_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY h, entity_id) <= greatest(1, CAST(floor(count(*) OVER (PARTITION BY stratum) * CAST(0.15 AS DOUBLE)) AS BIGINT)) AS in_val
            FROM (SELECT s AS entity_id, CASE WHEN ids = '' THEN 'singleton' ELSE 'matched' END AS stratum, md5('42' || s) AS h FROM truth)"""),
        "split_tables": with_base("""SELECT s AS entity_id, unnest(['s1_' || side, 'truth_' || side]) AS part FROM (
            SELECT s, CASE WHEN row_number() OVER (PARTITION BY ids = '' ORDER BY md5('42' || s), s) <= greatest(1, CAST(floor(count(*) OVER (PARTITION BY ids = '') * CAST(0.15 AS DOUBLE)) AS BIGINT)) THEN 'val' ELSE 'train' END AS side FROM truth)"""),
        "source_files": with_base("SELECT entity_id, nullif(business_name, '') AS business_name, nullif(business_address, '') AS business_address, nullif(country, '') AS country FROM src"),
        "truth_files": with_base("SELECT s AS source1_entity_id, nullif(ids, '') AS matched_entity_ids, nullif(business_name, '') AS business_name FROM truth JOIN src ON entity_id = s"),
        "result_files": with_base("SELECT r.s AS source1_entity_id, nullif(r.ids, '') AS matched_entity_ids, (SELECT string_agg(c, ',' ORDER BY c) FROM prs WHERE prs.s = r.s) AS candidate_entity_ids FROM results r", _SCORED),
        "threshold_file": "SELECT CAST(0.725 AS DOUBLE) AS stored, CAST(0.5 AS DOUBLE) AS absent",
        "positive_pairs": with_base(f"""SELECT {_IDS}, round(probability, 6) AS probability, round(best, 6) AS threshold FROM graded, (
            SELECT threshold AS best FROM (SELECT threshold, {_RATES}) ORDER BY f0_5 DESC, threshold LIMIT 1) WHERE probability >= best""", _SCORED + sweep),
        "pair_metrics": with_base(f"SELECT {_RATES}", _SCORED + at_half),
        "threshold_sweep": with_base(f"SELECT round(threshold, 6) AS threshold, {_RATES}", _SCORED + sweep),
        "match_output": with_base("SELECT s AS source1_entity_id, ids AS matched_entity_ids FROM results", _SCORED),
        "predicted_matches": with_base("SELECT s AS source1_entity_id, ids AS matched_entity_ids FROM results", _SCORED),
        "validate_output": with_base("""SELECT (SELECT count(*) FROM (SELECT s FROM results GROUP BY s HAVING count(*) > 1)) AS duplicate_rows, (SELECT count(*) FROM one WHERE entity_id NOT IN (SELECT s FROM results)) AS missing_rows,
            count(*) FILTER (WHERE len([i FOR i IN pred IF i LIKE 'S1-%']) > 0) AS s1_in_list, count(*) FILTER (WHERE len(pred) <> len(list_distinct(pred))) AS duplicate_in_list,
            (SELECT count(DISTINCT r.s) FROM (SELECT s, unnest(pred) AS c FROM results) r LEFT JOIN prs ON prs.s = r.s AND prs.c = r.c WHERE prs.s IS NULL) AS not_candidates FROM results""", _SCORED),
        "macro_f05": with_base(f"SELECT {_MACRO} FROM judged", _SCORED),
        "eval_report": with_base(f"SELECT {_MACRO}, CAST(sum(len(pred)) AS BIGINT) AS total_predicted, CAST(sum(len(tru)) AS BIGINT) AS total_true, round(stddev_pop(f), 6) AS f0_5_std, round(min(f), 6) AS f0_5_min, round(max(f), 6) AS f0_5_max, (SELECT round(CAST(n_covered AS DOUBLE) / n_true, 6) FROM {recall}) AS candidate_recall FROM judged", _SCORED),
        "scan_checks": with_base("""SELECT count(*) AS n_rows, count(*) FILTER (WHERE entity_id NOT LIKE 'S1-%') AS n_bad_prefix, (SELECT count(*) FROM (SELECT entity_id FROM one GROUP BY 1 HAVING count(*) > 1)) AS n_duplicate_ids,
            (SELECT count(*) FROM src WHERE business_name IS NULL) AS business_name, (SELECT count(*) FROM src WHERE business_address IS NULL) AS business_address, (SELECT count(*) FROM src WHERE country IS NULL) AS country FROM one"""),
    }
