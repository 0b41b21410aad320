"""The registered queries of these operators, and the SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookfuse.llm import chat, decontamination, divergence, html_text, language, lexical, line_dedup, lm, mixture, ngram_join, quality, token_counts, warc
from lookfuse.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four-word shingles, similarity 0.85."""
    return ngram_join.link_components(_table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


@_query
def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's share in the mix, and when it is first due."""
    planned = mixture.plan_mix(_table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken", "position")


@_query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    found = warc.archived(_table(spark, sf_dir, "pages"))
    return found.where("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents less the lines that many sites share."""
    cleaned = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


@_query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, by profiles of those that are not held out."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    profiles = language.train(docs.where(~F.col("held_out")))
    return language.identify(docs, profiles, keep=["doc_id", "held_out"])


@_query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model of those that are not held out."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 7, 2))
    return lm.score(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they contain."""
    return decontamination.find_contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of all documents, and whether they are kept."""
    judged = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept", "posterior")


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under a byte-level vocabulary of 50,257 entries."""
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as a log of streamed messages, folded, rendered and read back."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(chat.turn_events(turns.unionByName(more))))


@_query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms most typical of each."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


@_query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that score highest for each benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles_sql(table: str, key: str, width: int) -> str:
    found = _WORDS.format(_LOWER.format("text"))
    return f"""
        SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
            ELSE [array_to_string(w[i:i + {width - 1}], ' ') FOR i IN range(1, len(w) - {width - 2})] END) AS s
        FROM (SELECT {key}, {found} AS w FROM {table} WHERE text IS NOT NULL)"""


ORACLES["op1_ngram_join"] = f"""
    WITH RECURSIVE s AS ({_shingles_sql("documents", "doc_id", 4)}),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n k ON k.doc_id = a JOIN n m ON m.doc_id = b WHERE 100 * i >= 85 * (k.n + m.n - i)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
    LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id"""


def _mixture_sql() -> str:
    pieces = []
    for number, densities in enumerate(mixture.SCHEDULES):
        n = len(densities) - 1
        area = sum((a + b) / 2 for a, b in zip(densities, densities[1:])) / n  # noqa: B905
        reached, whens = 0.0, []
        for i in range(n):
            start, end = densities[i] / area, densities[i + 1] / area
            root = f"sqrt(greatest({start * start!r}::DOUBLE + {2 * (end - start) * n!r}::DOUBLE * (y - {reached!r}::DOUBLE), 0))"
            value = f"{i / n!r}::DOUBLE + 2.0::DOUBLE * (y - {reached!r}::DOUBLE) / ({start!r}::DOUBLE + {root})"
            reached += (start + end) / 2 / n
            whens.append(f"ELSE {value}" if i == n - 1 else f"WHEN y <= {reached!r}::DOUBLE THEN {value}")
        pieces.append(f"WHEN rank % {len(mixture.SCHEDULES)} = {number} THEN CASE {' '.join(whens)} END")
    takes = [f"greatest(0, least(size, whole - source_size * {p} - starts))" for p in range(mixture.MAX_REPEATS)]
    return rf"""
        WITH d AS (SELECT doc_id, source, coalesce(len({_WORDS.format("text")}), 0)::BIGINT AS size, md5('{mixture.SEED}' || doc_id) AS o FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
        w AS (SELECT *, rank % 3 + 1 AS weight, source_size * {mixture.MAX_REPEATS} AS lim FROM s),
        c AS (SELECT *, sum(source_size) OVER ()::BIGINT AS total,
                coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
                sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weights FROM w),
        k AS (SELECT *, lim * weights <= (total - before) * weight AS cut FROM c),
        t AS (SELECT *, CASE WHEN cut THEN lim::DOUBLE ELSE
                ((total - coalesce(sum(lim) FILTER (cut) OVER (), 0)::BIGINT) * weight)::DOUBLE / (sum(weight) FILTER (NOT cut) OVER ())::BIGINT END AS target FROM k),
        p AS (SELECT d.doc_id, size, source_size, target, rank, floor(target + 0.5)::BIGINT AS whole,
                coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, d.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS starts
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        f AS (SELECT *, {takes[0]} AS first, {" + ".join(takes)} AS taken, (starts + {takes[0]} / 2) / target AS y FROM p)
        SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
            CASE WHEN first > 0 THEN least(greatest(CASE {" ".join(pieces)} END, 0), 1) END AS position FROM f"""


ORACLES["op2_mixture"] = _mixture_sql()

ORACLES["op4_warc"] = f"""
    WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT d, min(page_id) AS first FROM p GROUP BY d)
    SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, url,
        CASE WHEN n >= {warc.MIN_SHARED} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= {warc.MIN_SHARED} AND page_id > first THEN first END AS refers_to
    FROM p JOIN f USING (d)"""

_BLANK = r"chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
ORACLES["op5_line_dedup"] = rf"""
    WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
    k AS (SELECT *, CASE WHEN len({_WORDS.format("raw")}) >= {line_dedup.MIN_WORDS} THEN trim(raw, {_BLANK}) END AS line FROM l),
    b AS (SELECT line, min(doc_id) AS first FROM k WHERE line IS NOT NULL GROUP BY line HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
    m AS (SELECT k.*, b.line IS NOT NULL AND k.doc_id <> b.first AS gone FROM k LEFT JOIN b ON k.line = b.line)
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '') END AS text,
        count(i)::BIGINT AS n_lines, (count(i) FILTER (gone))::BIGINT AS n_removed
    FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY d.doc_id, d.text"""

ORACLES["op8_decontamination"] = f"""
    WITH d AS ({_shingles_sql("documents", "doc_id", decontamination.WIDTH)}), q AS ({_shingles_sql("benchmark", "item_id", decontamination.WIDTH)}),
    n AS (SELECT item_id, count(*) AS item_shingles FROM q GROUP BY item_id),
    h AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN q USING (s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment FROM h JOIN n USING (item_id)
    WHERE shared >= {decontamination.THRESHOLD} * item_shingles - 1e-9"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '#', '\#'), '</', '<\/')"
ORACLES["op11_chat"] = rf"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    e AS (SELECT *, replace({_ESCAPED.format("role")}, chr(10), '\n') AS r, {_ESCAPED.format("text")} AS t FROM c),
    g AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
            coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss, sum(len(r) + len(t) + 13)::BIGINT AS chars FROM e GROUP BY conv_id)
    SELECT conv_id, n AS n_turns, sha256(said) AS turns_sha256, len(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, chars AS formatted_chars FROM g"""


def _share_sql(count: str, total: str) -> str:
    return f"1 + ({divergence.SCALE}::HUGEINT * ({count} + {divergence.SMOOTHING})) // ({total} + {divergence.SMOOTHING} * v)"


ORACLES["op12_divergence"] = rf"""
    WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    t AS (SELECT row, lang, source, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= {divergence.MIN_DOCS}),
    v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
    n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
    g AS (SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN n USING (lang, source) LEFT JOIN v USING (lang)),
    p AS (SELECT lang, source, term, c, {_share_sql("coalesce(c, 0)", "n")} AS p FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    q AS (SELECT lang, term, {_share_sql("c", "n")} AS q FROM (SELECT lang, term, sum(c) AS c FROM c GROUP BY lang, term)
            JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM g GROUP BY lang) USING (lang)),
    f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y USING (lang, term) GROUP BY ALL),
    r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
            LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
        UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
    o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM o WHERE part = 'pair' OR rank <= {divergence.TOP}"""


def _terms_sql(table: str, key: str) -> str:
    found = _LOWER.format("text")
    return f"SELECT {key}, unnest(regexp_extract_all({found}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {table} WHERE text IS NOT NULL"


ORACLES["op13_search"] = f"""
    WITH t AS ({_terms_sql("documents", "doc_id")}),
    f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
    s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term, docs),
    m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM d, s),
    q AS (SELECT DISTINCT * FROM ({_terms_sql("benchmark", "item_id")})),
    r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
        FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM r
    WHERE score > 0 QUALIFY rank <= {lexical.TOP}"""
