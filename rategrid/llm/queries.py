"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rategrid.llm import (
    ann,
    bpe,
    collocations,
    language,
    lines,
    merkle,
    packing,
    periodic,
    quality,
    simhash,
    token_output,
    toxicity,
    vector_dedup,
)
from rategrid.llm.features import held_out
from rategrid.plans.registry import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return function

    return register


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def judged(found: DataFrame, threshold: float) -> DataFrame:
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return judged(toxicity.score(docs, model), toxicity.THRESHOLD)


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return judged(quality.score(docs, model), quality.THRESHOLD)


@query("op3_token_output")
def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.read(token_output.write(table(spark, sf_dir, "documents")), checks=True)


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_and_decode(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        F.shiftright(F.length("ids"), 2).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, suffix, host, domain) of raw web pages."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    named = pages.select("page_id", text.alias("text"), declared.alias("declared"), host.alias("host"))
    blank = lambda c: F.when(c != "", c)
    return named.select(
        "page_id", "text", blank(F.col("declared")).alias("declared"),
        blank(F.substring_index("host", ".", -1)).alias("suffix"), blank(F.col("host")).alias("host"),
        blank(F.substring_index("host", ".", -2)).alias("domain"),
    )


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train(table(spark, sf_dir, "documents"))
    pages = page_evidence(table(spark, sf_dir, "pages"))
    return language.identify(
        pages, model, "page_id", "text", declared="declared", suffix="suffix", host="host", domain="domain"
    )


@query("op7_line_dedup")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, counts=("n_lines", "n_dropped"))


@query("op8_merkle", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    n AS (SELECT doc_id, t, length(t) AS n_chars,
                 coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nx
          FROM d),
    e AS (SELECT doc_id, n_chars, t, nx,
                 substr(t, 1, n_chars - n_chars // 4) || substr(nx, 1, n_chars // 4) AS ed FROM n),
    x AS (SELECT doc_id, unnest([0, 1, 2]) AS kind, unnest([t, ed, nx]) AS text FROM e),
    t AS (SELECT doc_id, kind,
                 list_transform(string_split(text, chr(10) || chr(10)), lambda s:
                   list_transform(string_split(s, chr(10)), lambda p: struct_pack(p := p, gap := CASE WHEN contains(p, ' ') THEN ' ' ELSE '' END,
                     v := list_transform(CASE WHEN contains(p, ' ') THEN string_split(p, ' ') ELSE regexp_extract_all(p, '(?s).') END,
                       lambda w: struct_pack(w := w, cut := CASE WHEN w = '' THEN true WHEN contains(p, ' ')
                         THEN (unicode(w) + length(w)) % 4 = 0 ELSE unicode(w) % 16 = 0 END))))) AS ws
          FROM x),
    w AS (SELECT doc_id, kind, list_transform(ws, lambda s: list_transform(s, lambda q: struct_pack(h := md5(q.p),
                   r := CASE q.gap WHEN ' ' THEN flatten(list_transform(string_split(regexp_replace(
                       array_to_string(list_transform(q.v, lambda w: w.w || CASE WHEN w.cut THEN chr(1) ELSE '' END), ' '),
                       '\x01$', ''), chr(1) || ' '), lambda r: CASE WHEN len(string_split(r, ' ')) > 64
                       THEN list_transform(range(0, len(string_split(r, ' ')), 4), lambda i:
                         array_to_string(list_slice(string_split(r, ' '), i + 1, i + 4), ' ')) ELSE [r] END))
                     ELSE flatten(list_transform(string_split(regexp_replace(coalesce(
                       array_to_string(list_transform(q.v, lambda w: w.w || CASE WHEN w.cut THEN chr(1) ELSE '' END), ''), ''),
                       '\x01$', ''), chr(1)), lambda r: CASE WHEN length(r) > 64
                       THEN list_transform(range(0, length(r), 16), lambda i: substr(r, i + 1, 16)) ELSE [r] END)) END))) AS rs
          FROM t),
    p AS (SELECT doc_id, kind, list_transform(rs, lambda s: list_transform(s, lambda q: struct_pack(h := q.h,
                   r := list_transform(q.r, lambda r: substr(md5(r), 1, 8))))) AS ps
          FROM w),
    s AS (SELECT doc_id, kind, list_transform(ps, lambda s: struct_pack(
                   h := md5(array_to_string(list_transform(s, lambda q: q.h), '')),
                   b := array_to_string(list_transform(s, lambda q:
                          substr(q.h, 1, 8) || '.' || array_to_string(q.r, '.')), ','))) AS ss,
                 flatten(list_transform(ps, lambda s: flatten(list_transform(s, lambda q: q.r)))) AS runs
          FROM p),
    f AS (SELECT doc_id, kind, runs, md5(array_to_string(list_transform(ss, lambda s: s.h), '')) AS root,
                 array_to_string(list_transform(ss, lambda s: substr(s.h, 1, 8) || '=' || s.b), ';') AS below
          FROM s),
    m AS (SELECT a.doc_id, b.kind, a.root || ':' || a.below AS fp, b.root || ':' || b.below AS other,
                 CASE WHEN a.root = b.root THEN 1.0 ELSE least(0.9999, greatest(
                   2.0 * len(list_distinct(list_intersect(a.runs, b.runs)))
                     / (len(list_distinct(a.runs)) + len(list_distinct(b.runs))),
                   CAST(len(list_filter(range(1, least(len(a.runs), len(b.runs)) + 1),
                          lambda i: a.runs[i] = b.runs[i])) AS DOUBLE)
                     / greatest(len(a.runs), len(b.runs)))) END AS near
          FROM f a JOIN f b ON a.doc_id = b.doc_id AND a.kind = 0 AND b.kind > 0)
    SELECT e.doc_id, CAST(e.n_chars AS BIGINT) AS n_chars, sha256(e.ed) AS edited_sha256, one.fp AS fingerprint,
           one.other AS edited_fingerprint, CAST(one.near AS DOUBLE) AS near_edited, CAST(two.near AS DOUBLE) AS near_next
    FROM e JOIN m one ON one.doc_id = e.doc_id AND one.kind = 1
           JOIN m two ON two.doc_id = e.doc_id AND two.kind = 2
    """)
def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.compare_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_ann")
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of a tenth of the documents the words from some place on repeat the first of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h")).select(
        "doc_id", "text", "h",
        F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("w"),
    )
    n, g = F.size("w").cast("bigint"), F.floor(F.col("h") / 10)
    a = F.col("a")
    placed = words.withColumn("a", F.when(n > 0, g % n)).withColumn(
        "p", 1 + F.floor((n - a) / (3 + g % 8))
    )
    cycle = F.slice("w", (a + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((n - a) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(cycle, times)), 1, (n - a).cast("int"))
    whole = F.array_join(F.concat(F.slice("w", 1, a.cast("int")), tail), " ")
    return placed.select("doc_id", F.when(a.isNotNull(), whole).otherwise(F.col("text")).alias("text"))


@query("op11_runs", r"""
    WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                        lambda w: w <> '') AS w,
                      CAST(xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                        lambda c: CAST(ord(c) AS BIGINT)),
                        lambda crc, b: list_reduce([CAST(1 AS BIGINT), 2, 3, 4, 5, 6, 7, 8],
                          lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END,
                          xor(crc, b)),
                        CAST(4294967295 AS BIGINT))) AS BIGINT) AS h
               FROM documents),
    g AS (SELECT doc_id, w, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS planted FROM d),
    a AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM g),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    t AS (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n),
                 lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM p),
    grams AS (SELECT doc_id, unnest(range(n - 15)) AS i, unnest(list_transform(range(n - 15),
                     lambda i: array_to_string(list_slice(w, i + 1, i + 16), ' '))) AS gram
              FROM t WHERE n >= 24),
    pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM grams x JOIN grams y USING (doc_id, gram) WHERE y.i > x.i),
    islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
    stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + 15 + q AS l FROM islands GROUP BY doc_id, q, island),
    runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(24, 3 * q) GROUP BY doc_id, s, l),
    best AS (SELECT doc_id, s, l, q FROM runs
             QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) = 1),
    listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS said,
                      list({'b': s + q, 'e': s + l}) AS cuts
               FROM runs GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
           CAST(best.q AS BIGINT) AS period, CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli,
           sha256(coalesce(said, '')) AS runs_sha256,
           sha256(CASE WHEN cuts IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_transform(list_filter(
             range(n), lambda i: len(list_filter(cuts, lambda c: i >= c.b AND i < c.e)) = 0),
             lambda i: w[i + 1]), ' ') END) AS collapsed_sha256
    FROM t LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)
    """)
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longer = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    # Runs come by start, then period; so the first of equals stays.
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda one, r: F.when(longer(r, one), r).otherwise(one))
    said = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op12_collocations", r"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    sizes AS (SELECT unnest([1, 2, 3, 4, 5]) AS size),
    grams AS (SELECT lang, size, unnest(list_transform(range(len(w) - size + 1),
                lambda i: array_to_string(list_slice(w, i + 1, i + size), ' '))) AS phrase
              FROM w, sizes WHERE len(w) >= size),
    f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 100),
    c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
    inner_parts AS (SELECT lang, a, unnest(flatten(list_transform(range(2, size), lambda m:
                      list_transform(range(size - m + 1), lambda i:
                        array_to_string(list_slice(w, i + 1, i + m), ' '))))) AS phrase FROM c WHERE size > 2),
    covered AS (SELECT lang, phrase, max(a) AS cover FROM inner_parts GROUP BY lang, phrase),
    kept AS (SELECT c.* FROM c LEFT JOIN covered USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < 100 * a),
    cuts AS (SELECT lang, phrase, a, w, size, unnest(range(1, size)) AS k FROM kept),
    scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, k, x.f AS l, y.f AS r, n,
                      CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
               FROM cuts JOIN totals USING (lang)
               JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(list_slice(w, 1, k), ' ')
               JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(list_slice(w, k + 1, cuts.size), ' ')),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM best QUALIFY rank <= 2000
    """)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_vector_dedup", """
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
              AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
              UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
    """)
def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
