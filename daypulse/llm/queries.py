"""Registered queries of the operators; each thin query derives its columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm import ann, chat, decontam, hyperminhash, packing, phrases, pii, quality, runs, simhash, substring, toxicity, urlfilter
from daypulse.llm.common import id_remainder, table
from daypulse.llm.tokenizers_path import vocabulary

RULES = [
    urlfilter.Rule("block", "net"),
    urlfilter.Rule("allow", "example.net", "/en/"),
    urlfilter.Rule("block", "example.com", "/de/"),
    urlfilter.Rule("allow", "org", "/fr/"),
]


def _held_out(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", (id_remainder(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), RULES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _held_out(quality.score(docs, model, threshold=0.3))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), every=True)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _held_out(toxicity.score(docs, model, threshold=0.5))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.pieces(turns.unionByName(probe)))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, best=2000)


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; with h = crc32(doc_id) divisible by 10 the words from a = g % n on, g = h // 10, repeat words
    a to a + p, p = 1 + (n - a) // (3 + g % 8).  Null ids and texts without words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # lambda arguments hold the words, a and p, so that each is computed once a row
    repeated = F.expr(r"""
        transform(array(regexp_extract_all(text, '([^\\x20\\x09-\\x0D]+)', 1)), w ->
            transform(array(named_struct('n', size(w), 'a', g % size(w))), s ->
                transform(array(1 + floor((s.n - s.a) / (3 + g % 8))), p ->
                    array_join(transform(sequence(0, s.n - 1), i -> get(w, cast(if(i < s.a, i, s.a + (i - s.a) % p) as int))), ' ')
                )[0])[0])[0]
    """)
    wordy = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & wordy, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_planted(table(spark, sf_dir, "documents")), least=12)
    longest = F.expr("""
        aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (m, r) ->
            if(m is null or r.length > m.length, r, m))
    """)  # runs come by start, then period: the first of equal lengths stays
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash, op2_url_filter, op3_packing, op4_quality, op5_pii, op6_substring_dedup, op7_ann, op8_decontamination,
        op9_toxicity, op10_chat_format, op11_minhash, op12_phrases, op13_periodic_runs,
    )
}
ORACLE: dict[str, str] = {
    "op2_url_filter": """
        WITH p AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), q AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM p
        ), r AS (
            SELECT page_id, host, path, '.' || host AS h,
                   CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM q
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
                    WHEN rule IS NOT NULL THEN 'block'
                    WHEN h LIKE '%.ads-%' OR h LIKE '%.adult-%' OR h LIKE '%.casino-%' OR h LIKE '%.cheap-pills%'
                         OR h LIKE '%.free-bets%' OR h LIKE '%.spam-%' THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM r
    """,
    "op10_chat_format": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), e AS (
            SELECT *, row_number() OVER w AS n,
                   sum(length('<|' || role || '|>' || chr(10) || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')
                              || '</s>' || chr(10))) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS stop
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(CASE WHEN role = 'assistant' THEN stop ELSE 0 END)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op11_minhash": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
                ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM w
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), c AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
        ), l AS (
            SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
        ), e AS (
            SELECT a, b FROM l UNION ALL SELECT b, a FROM l
        ), r AS (
            SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
        )
        SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reached) AS component_id, r.doc_id = min(reached) AS kept
        FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
    """,
    "op12_phrases": """
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, doc, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k
            FROM (SELECT lang, row_number() OVER () AS doc,
                         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents)
        ), t AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p
        ), g AS (
            SELECT lang, x AS len, list_aggregate(list_slice(w, i, i + x - 1), 'string_agg', ' ') AS phrase
            FROM (SELECT lang, w, x, unnest(range(1, len(w) - x + 2)) AS i FROM t, (SELECT unnest([1, 2, 3, 4, 5]) AS x) WHERE len(w) >= x)
        ), f AS (
            SELECT lang, len, phrase, count(*) AS f FROM g GROUP BY ALL
        ), n AS (
            SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len = 1 GROUP BY lang
        ), c AS (
            SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE len > 1 AND f >= 100
        ), cuts AS (
            SELECT c.lang, c.phrase, c.a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, len)) AS k FROM c) c
        ), s AS (
            SELECT u.lang, u.phrase, u.a, u.k, x.f AS l, y.f AS r, n.n,
                   ((1000::HUGEINT * u.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.head JOIN f y ON y.lang = u.lang AND y.phrase = u.tail
            JOIN n ON n.lang = u.lang
        ), low AS (
            SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), kept AS (
            SELECT low.* FROM low WHERE NOT EXISTS (
                SELECT 1 FROM c WHERE c.lang = low.lang AND c.a >= low.a AND c.phrase <> low.phrase
                AND contains(' ' || c.phrase || ' ', ' ' || low.phrase || ' '))
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
    "op13_periodic_runs": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                   xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))),
                       4294967295) AS h
            FROM documents
        ), s AS (
            SELECT doc_id, w, len(w)::BIGINT AS n, h, h // 10 AS g FROM d
        ), p AS (
            SELECT doc_id, w, n, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, g FROM s
        ), t AS (
            SELECT doc_id, CASE WHEN a IS NULL THEN w
                ELSE list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w
            FROM p
        ), e AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM t
        ), m AS (
            SELECT x.doc_id, y.i - x.i AS q, x.i FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
        ), b AS (
            SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island, i FROM m
        ), f AS (
            SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM b GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(12, 2 * q)
        ), r AS (
            SELECT doc_id, start, length, min(q) AS period FROM f GROUP BY doc_id, start, length
        ), top AS (
            SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
        ), every AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
            FROM r GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS line FROM e
            WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = e.doc_id AND e.i >= r.start + r.period AND e.i < r.start + r.length)
            GROUP BY doc_id
        )
        SELECT t.doc_id, coalesce(every.n_runs, 0)::BIGINT AS n_runs, top.start::BIGINT AS start, top.length::BIGINT AS length, top.period::BIGINT AS period,
               (1000 * top.length // top.period)::BIGINT AS exponent_milli, sha256(coalesce(every.lines, '')) AS runs_sha256,
               sha256(coalesce(kept.line, '')) AS collapsed_sha256
        FROM t LEFT JOIN every USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op6_substring_dedup": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), e AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d
        ), windows AS (
            SELECT doc_id, i, list_aggregate(list_slice(w, i + 1, i + 20), 'string_agg', ' ') AS x
            FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)
        ), again AS (
            SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS line
            FROM e ANTI JOIN gone ON gone.doc_id = e.doc_id AND gone.i = e.i GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.line, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
}
