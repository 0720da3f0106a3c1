"""Catalog part 3: text path (email body parsing, TF-IDF postings, F-test
selection, stemming) and keyed record-set sources/sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.functions import text as TX
from raremine.functions.numeric import round_doubles
from raremine.operators import sampling as S
from raremine.operators import stats as ST
from raremine.operators import text as TO
from raremine.plans.standins import PERSON_CLEAN_SQL, with_ctes
from raremine.sources import files as FS
from raremine.sources import record_files as RF
from raremine.sources.tables import read_table

Q: dict = {}
SQL: dict = {}

STOP = TX.english_stop_words()
STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP) + "]"
PUNCT_SQL = "'" + TX.PUNCTUATION.replace("'", "''") + "'"


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r(df, digits=6):
    return round_doubles(df, digits)


def emails(spark, sf) -> DataFrame:
    """Documents rendered as email files: a header block, the marker line,
    then the body (the driver tables hold no mail files)."""
    d = read_table(spark, sf, "documents")
    value = F.concat(F.lit("Message-ID: <"), F.col("doc_id").cast("string"), F.lit(">\n"),
                     F.lit(TX.MARKER), F.lit(" doc"), F.col("doc_id").cast("string"), F.lit(".nsf\n"), F.col("text"))
    return d.select("doc_id", value.alias("value"))


EMAIL_SQL = ("em AS (SELECT doc_id, 'Message-ID: <' || CAST(doc_id AS VARCHAR) || '>' || chr(10) || 'X-FileName: doc'"
             " || CAST(doc_id AS VARCHAR) || '.nsf' || chr(10) || text AS value FROM documents)")
BODY_SQL = "bd AS (SELECT doc_id, string_split(value, 'X-FileName:')[2] AS body FROM em)"
STRIP_SQL = f"st AS (SELECT doc_id, translate(body, {PUNCT_SQL}, '') AS stripped FROM bd)"


@register("str_after_marker", with_ctes(EMAIL_SQL, BODY_SQL) + " SELECT doc_id, body FROM bd")
def q_str_after_marker(spark, sf):
    return emails(spark, sf).select("doc_id", TX.after_marker(F.col("value")).alias("body"))


@register("src_email_text", with_ctes(EMAIL_SQL) + " SELECT doc_id, CAST(coalesce(length(value), 0) AS INTEGER) AS n_chars FROM em")
def q_src_email_text(spark, sf):
    """Mail files, one per document, are written by the record-file source and
    read back whole; the id is in the file's name."""
    path = _scratch(spark, "mails")
    RF.write_records(emails(spark, sf).select(F.concat(F.lit("mail-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), "value"), path)
    mails = RF.read_records(spark, path)
    return mails.select(F.regexp_extract("name", "mail-(.*)\\.txt", 1).cast("long").alias("doc_id"), F.length("value").alias("n_chars"))


@register("str_strip_punct", with_ctes(EMAIL_SQL, BODY_SQL, STRIP_SQL) + " SELECT doc_id, stripped FROM st")
def q_str_strip_punct(spark, sf):
    body = emails(spark, sf).select("doc_id", TX.after_marker(F.col("value")).alias("body"))
    return body.select("doc_id", TX.strip_punct(F.col("body")).alias("stripped"))


@register("str_split_ws", with_ctes(EMAIL_SQL, BODY_SQL, STRIP_SQL,
                                    "ws AS (SELECT doc_id, list_filter(regexp_split_to_array(stripped,"
                                    " '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '') AS words FROM st)") +
          " SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, array_to_string(words, ' ') AS joined FROM ws")
def q_str_split_ws(spark, sf):
    body = emails(spark, sf).select("doc_id", TX.strip_punct(TX.after_marker(F.col("value"))).alias("s"))
    words = body.select("doc_id", TX.split_ws(F.col("s")).alias("w"))
    return words.select("doc_id", F.size("w").alias("n_words"), F.array_join("w", " ").alias("joined"))


@register("text_stem_join")
def q_text_stem_join(spark, sf):
    """Snowball-English stems of every body word, joined by one space."""
    body = emails(spark, sf).select("doc_id", TX.strip_punct(TX.after_marker(F.col("value"))).alias("body"))
    return TO.stem_join(body, "doc_id", "body")


@register("join_doc_label",
          "SELECT d.doc_id, l.quality, l.toxic, d.n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def q_join_doc_label(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    return d.join(read_table(spark, sf, "labels"), "doc_id").select("doc_id", "quality", "toxic", "n_chars")


@register("src_labelled_docs",
          "SELECT d.doc_id, l.quality AS label, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def q_src_labelled_docs(spark, sf):
    return labelled_docs(spark, sf).select("doc_id", "label", "text")


def labelled_docs(spark, sf) -> DataFrame:
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return d.join(read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


# ---------------------------------------------------------------- TF-IDF --

def _split_docs(spark, sf):
    h = S.split_holdout(labelled_docs(spark, sf), 0.1, key="doc_id")
    return h.withColumn("is_train", ~F.col("is_test")).drop("is_test")


TFIDF_SQL = [
    "d AS (SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id)",
    "h AS (SELECT *, NOT (row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR))), doc_id)"
    " <= ceil(0.1 * count(*) OVER ())) AS is_train FROM d)",
    "tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM h)",
    f"stop AS (SELECT unnest({STOP_SQL}) AS term)",
    "tc AS (SELECT doc_id, term, count(*) AS c FROM tok WHERE term NOT IN (SELECT term FROM stop) GROUP BY doc_id, term)",
    "ntr AS (SELECT count(*) AS n FROM h WHERE is_train)",
    "voc AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM tc JOIN h USING (doc_id), ntr"
    " WHERE is_train GROUP BY term, n HAVING count(*) <= 0.5 * n)",
    "raw AS (SELECT doc_id, term, (1 + ln(c)) * idf AS w0 FROM tc JOIN voc USING (term))",
    "post AS (SELECT doc_id, term, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY doc_id)) AS w FROM raw)",
]


@register("tfidf", with_ctes(*TFIDF_SQL) + " SELECT doc_id, term, round(w, 6) AS w FROM post")
def q_tfidf(spark, sf):
    h = _split_docs(spark, sf)
    return r(TO.tfidf(h, "is_train", "doc_id", "text", 0.5, STOP))


FTEST_SQL = TFIDF_SQL + [
    "tp AS (SELECT p.doc_id, p.term, p.w, h.label FROM post p JOIN h USING (doc_id) WHERE h.is_train)",
    "cls AS (SELECT label, count(*) AS n FROM h WHERE is_train GROUP BY label)",
    "terms AS (SELECT DISTINCT term FROM tp)",
    "agg AS (SELECT term, label, sum(w) AS s, sum(w * w) AS q FROM tp GROUP BY term, label)",
    "g AS (SELECT t.term AS feature, c.label, c.n, coalesce(a.s, 0) / c.n AS m,"
    " coalesce(a.q, 0) / c.n - pow(coalesce(a.s, 0) / c.n, 2) AS v"
    " FROM terms t CROSS JOIN cls c LEFT JOIN agg a ON a.term = t.term AND a.label = c.label)",
    "gt AS (SELECT feature, sum(n) AS nn, count(*) AS k, sum(n * m) / sum(n) AS mm, sum(n * v) AS ssw"
    " FROM g GROUP BY feature)",
    "fs AS (SELECT g.feature, (sum(g.n * pow(g.m - t.mm, 2)) / nullif(t.k - 1, 0)) /"
    " nullif(t.ssw / nullif(t.nn - t.k, 0), 0) AS f FROM g JOIN gt t USING (feature) GROUP BY g.feature, t.k, t.ssw, t.nn)",
    "sc AS (SELECT * FROM fs WHERE f IS NOT NULL)",
    "thr AS (SELECT quantile_cont(f, 0.9) AS t, count(*) AS n FROM sc)",
    "above AS (SELECT feature, f FROM sc, thr WHERE f > t)",
    "ties AS (SELECT feature, f FROM (SELECT feature, f, row_number() OVER (ORDER BY feature) AS rn FROM sc, thr"
    " WHERE f = t) WHERE rn <= CAST(floor((SELECT n FROM thr) * 10 / 100.0) AS BIGINT) - (SELECT count(*) FROM above))",
]


@register("anova_f_text", with_ctes(*FTEST_SQL) + " SELECT feature AS term, round(f, 6) AS f FROM fs")
def q_anova_f_text(spark, sf):
    """F per term from the training postings (zeros implied)."""
    h = _split_docs(spark, sf)
    post = TO.tfidf(h, "is_train", "doc_id", "text", 0.5, STOP)
    train = h.filter("is_train")
    fs = TO.anova_f_postings(post.join(train.select("doc_id"), "doc_id"), train)
    return r(fs.select("term", "f"))


@register("text_features", with_ctes(*FTEST_SQL) +
          " SELECT feature AS term, round(f, 6) AS f FROM above UNION ALL SELECT feature AS term, round(f, 6) AS f FROM ties")
def q_text_features(spark, sf):
    """TF-IDF -> F-test top 10 % of terms (fitted on the training documents)."""
    h = _split_docs(spark, sf)
    post = TO.tfidf(h, "is_train", "doc_id", "text", 0.5, STOP)
    train = h.filter("is_train")
    fs = TO.anova_f_postings(post.join(train.select("doc_id"), "doc_id"), train)
    sel = ST.select_percentile(fs.withColumnRenamed("term", "feature"), 10.0)
    return r(sel.select(F.col("feature").alias("term"), "f"))


@register("select_percentile_text_matrix", with_ctes(*FTEST_SQL) +
          " SELECT p.doc_id, p.term, round(p.w, 6) AS w, h.label, h.is_train FROM post p"
          " JOIN (SELECT feature AS term FROM above UNION ALL SELECT feature AS term FROM ties) s ON s.term = p.term"
          " JOIN h ON h.doc_id = p.doc_id")
def q_select_percentile_text_matrix(spark, sf):
    """The selected postings of train and test documents (the sparse form of
    the reference's two dense matrices), with labels."""
    h = _split_docs(spark, sf)
    post = TO.tfidf(h, "is_train", "doc_id", "text", 0.5, STOP)
    train = h.filter("is_train")
    fs = TO.anova_f_postings(post.join(train.select("doc_id"), "doc_id"), train)
    sel = ST.select_percentile(fs.withColumnRenamed("term", "feature"), 10.0).select(F.col("feature").alias("term"))
    kept = post.join(sel, "term", "left_semi")
    return r(kept.join(h.select("doc_id", "label", "is_train"), "doc_id"))


@register("text_model_transform", with_ctes(*FTEST_SQL) +
          " SELECT p.doc_id, p.term, round(p.w, 6) AS w FROM post p"
          " JOIN (SELECT feature AS term FROM above UNION ALL SELECT feature AS term FROM ties) s ON s.term = p.term"
          " JOIN h ON h.doc_id = p.doc_id WHERE NOT h.is_train")
def q_text_model_transform(spark, sf):
    """The text model is fitted on the training documents, saved, loaded and
    applied to the others, which it has not seen."""
    h = _split_docs(spark, sf)
    path = _scratch(spark, "text_model")
    TO.TextModel.fit(h.filter("is_train"), path, stop_words=STOP)
    return r(TO.TextModel.load(spark, path).transform(h.filter("not is_train"), selected=True))


# ------------------------------------------------------- keyed record sets --

@register("src_keyed_records",
          "SELECT event_id AS id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,"
          " CAST(NULL AS INTEGER) AS missing_feature FROM events")
def q_src_keyed_records(spark, sf):
    ev = read_table(spark, sf, "events")
    recs = ev.select(F.col("event_id").alias("id"), F.from_json("props", FS.MAP_TYPE).alias("values"))
    return FS.records_to_frame(recs, ["k", "missing_feature"], types={"k": "int", "missing_feature": "int"})


@register("sink_keyed_records", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT id, round(total_price, 6) AS total_price, round(n_high, 6) AS n_high FROM person_clean")
def q_sink_keyed_records(spark, sf):
    """Frame -> {id: {feature: value}} written as JSON under the checkpoint
    folder, read back and re-typed."""
    from raremine.plans.catalog_tabular import pclean
    from raremine.session import scratch_path

    path = scratch_path(spark, "records")
    FS.frame_to_records(pclean(spark, sf)).write.mode("overwrite").json(path)
    back = spark.read.schema("id string, `values` map<string,string>").json(path)
    clean = FS.records_to_frame(back, ["total_price", "n_high"])
    from raremine.operators.clean import clean_sentinel_numeric
    return r(clean.select("id", *[clean_sentinel_numeric(F.col(c)).alias(c) for c in ("total_price", "n_high")]))


# ------------------------------------------------------ file-based sources --

def _scratch(spark, name: str) -> str:
    from raremine.session import scratch_path
    return scratch_path(spark, "source-" + name)


EMAIL_INDEX_SQL = ("SELECT CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN 'from' ELSE 'to' END AS direction,"
                   " 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS address,"
                   " 'maildir/user' || CAST(user_id AS VARCHAR) || '/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.'"
                   " AS path, 4 AS n_parts FROM events")


#: Lines of an index file; an address with more has several files of its name.
INDEX_LINES = 20_000


@register("src_email_index", EMAIL_INDEX_SQL)
def q_src_email_index(spark, sf):
    """An email index derived from ``events`` is written as files named after
    direction and address, with one mail path a line, then read back."""
    ev = read_table(spark, sf, "events")
    direction = F.when(F.col("event_type").isin("click", "purchase", "signup"), "from").otherwise("to")
    name = F.concat(direction, F.lit("_user"), F.col("user_id").cast("string"), F.lit("@example.com.txt"))
    line = F.concat(F.lit("maildir/user"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"),
                    F.lit("/"), F.col("event_id").cast("string"), F.lit("."))
    lines = ev.select(name.alias("name"), line.alias("line"))
    sizes = lines.groupBy("name").agg(F.ceil(F.count(F.lit(1)) / F.lit(INDEX_LINES)).alias("files"))
    files = (lines.join(sizes, "name").groupBy("name", F.pmod(F.xxhash64("line"), F.col("files")).alias("part"))
             .agg(F.array_join(F.collect_list("line"), "\n").alias("value")))
    path = _scratch(spark, "email_index")
    RF.write_records(files, path)
    found = RF.read_records(spark, path).select("name", F.explode(F.split("value", "\n")).alias("value"))
    return FS.parse_email_index(found)


@register("src_poi_names", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT CASE WHEN poi = 1 THEN 'y' ELSE 'n' END AS flag, split_part(id, '#', 1) AS last,"
          " split_part(id, '#', 2) AS first FROM person_clean WHERE id <> 'TOTAL'")
def q_src_poi_names(spark, sf):
    """A '(y|n) Last, First' list (with a URL header and a blank line) is
    written from the person table and parsed back."""
    from raremine.plans.catalog_tabular import pclean
    from raremine.operators.clean import drop_row_by_key

    p = drop_row_by_key(pclean(spark, sf))
    parts = F.split("id", "#")
    lines = p.select(F.concat(F.lit("("), F.when(F.col("poi") == 1, "y").otherwise("n"), F.lit(") "),
                              F.get(parts, 0), F.lit(", "), F.get(parts, 1)).alias("value"))
    header = spark.createDataFrame([("http://example.org/poi-list",), ("",)], "value string")
    path = _scratch(spark, "poi_names")
    header.unionByName(lines).write.mode("overwrite").text(path)
    return FS.read_poi_names(spark, path)


@register("src_poi_addresses", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT DISTINCT email_address AS address FROM person_clean WHERE poi = 1 AND email_address IS NOT NULL")
def q_src_poi_addresses(spark, sf):
    """Address list of the positive class (quoted/fused entries normalised)."""
    from raremine.plans.catalog_tabular import pclean

    p = pclean(spark, sf).filter((F.col("poi") == 1) & F.col("email_address").isNotNull())
    quoted = p.select(F.concat(F.lit("'"), F.col("email_address"), F.lit("'")).alias("address"))
    return FS.normalize_addresses(quoted)


@register("ff_missing_feature", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, count(*) FILTER (WHERE NOT list_contains(json_keys(props), '{f}')) AS n_missing,"
    f" bool_and(list_contains(json_keys(props), '{f}')) AS present FROM events" for f in ("k", "salary")))
def q_ff_missing_feature(spark, sf):
    """Requested features checked against the keys of every keyed record
    (``feature_format`` raises ValueError for the absent ones)."""
    from raremine.operators.clean import missing_in_records

    records = read_table(spark, sf, "events").select(F.from_json("props", FS.MAP_TYPE).alias("values"))
    return missing_in_records(records, ["k", "salary"])
