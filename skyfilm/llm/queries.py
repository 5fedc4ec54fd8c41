"""The registered opN_ queries: whole tables in, the contract's columns out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from .chunk_codec import encode_documents
from .collocations import COVERED, FIRST, LEAST, collocations
from .hpy_lm import score_texts
from .line_dedup import LEAST_PAGES, RATIO, dedup_lines
from .mixing import BLOCK, PERIOD, mix_sources
from .ngram_join import near_duplicates
from .packing import pack_documents
from .quality import judge_quality
from .rp_forest import nearest
from .token_counts import token_counts
from .toxicity import fit_lexicon, in_training, score_toxicity
from .url_rules import judge_urls, rules_frame
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, books_sha256, compress_vectors, label_errors

URL_RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir, "doc_id", "source"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, _documents(spark, sf_dir, "doc_id", "text"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_documents(spark, sf_dir, "doc_id", "source", "text")).select("doc_id", "n_lines", "n_dropped_lines", "text")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, rules_frame(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    lexicon = fit_lexicon(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, lexicon).select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "score", "predicted", "n_hits")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(spark, _documents(spark, sf_dir, "doc_id", "text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    return token_counts(_documents(spark, sf_dir, "doc_id", "text"), *paths, public_tokenizers.PATTERN)


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return score_texts(spark, _documents(spark, sf_dir, "doc_id", "text"), held_out)


def op11_chunk_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    # decoded where it is encoded, so that no second Python worker stands beside the first
    coded = encode_documents(_documents(spark, sf_dir, "doc_id", "text"), tokenizer, ranks, public_tokenizers.PATTERN, with_text=True)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return coded.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, _documents(spark, sf_dir, "text", "lang"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return label_errors(spark, coded).select("vec_id", code.alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_source_mixing, op2_ngram_jaccard_join, op3_packing, op4_line_dedup, op5_url_rules, op6_nearest_vectors, op7_toxicity, op8_quality_rules, op9_token_counts, op10_lm_scores, op11_chunk_codec, op12_collocations, op13_vector_codes)
} | {"pipeline": corpus_pipeline.run}

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_RULES = ", ".join(f"('{r}', '{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for r, v in URL_RULES)
_LINE = "trim(regexp_replace(line, '[\\t\\r]', ' ', 'g'))"

_NEAR = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"


def _assigned(book: str) -> str:
    return f"SELECT place, i, any_value(vec_id) AS vec_id, any_value(label) AS label, any_value(x) AS x, min({{'d': {_NEAR}, 'e': e}}) AS best FROM parts JOIN {book} USING (place) GROUP BY place, i"


def _moved(book: str, assigned: str) -> str:
    means = f"SELECT place, best.e AS e, j, sum(x[j])::HUGEINT AS t, count(*)::HUGEINT AS m FROM {assigned}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS j) GROUP BY ALL"
    entries = f"SELECT place, e, list((CASE WHEN t < 0 THEN -((-t + m - 1) // m) ELSE t // m END)::BIGINT ORDER BY j) AS c FROM ({means}) GROUP BY ALL"
    return f"SELECT b.place, b.e, coalesce(n.c, b.c) AS c FROM {book} b LEFT JOIN ({entries}) n USING (place, e)"


_ROUNDS = ", ".join(f"a{k} AS ({_assigned(f'b{k}')}), b{k + 1} AS ({_moved(f'b{k}', f'a{k}')})" for k in range(ROUNDS))

ORACLES: dict[str, str] = {
    "op1_source_mixing": f"""
        WITH RECURSIVE s AS (SELECT source, greatest(1, round(w / sum(w) OVER () * {PERIOD}))::BIGINT AS q
                             FROM (SELECT source, pow(count(*)::DOUBLE, 0.5) AS w FROM documents GROUP BY 1)),
        items AS (SELECT list({{'s': source, 'q': q}} ORDER BY (CASE WHEN source IS NULL THEN 'n' ELSE 's' END) || coalesce(source, '')) AS x, sum(q)::BIGINT AS p, count(*) AS n FROM s),
        run(t, done, i, k) AS (
            SELECT -1::BIGINT, list_transform(x, lambda y: 0::BIGINT), 0::BIGINT, -1::BIGINT FROM items
            UNION ALL
            SELECT t + 1, list_transform(done, lambda d, j: d + (j = pick)::BIGINT), pick, done[pick]
            FROM (SELECT t, done, list_sort(list_filter(list_transform(range(1, n + 1), lambda j: {{'d': ((done[j] + 1) * p + x[j].q - 1) // x[j].q, 'q': x[j].q, 'i': j, 'early': done[j] * p // x[j].q > t + 1}}),
                                             lambda c: NOT c.early))[1].i AS pick FROM run, items WHERE t + 1 < p)),
        plan AS (SELECT x[i].s AS source, x[i].q AS q, p, k, t AS slot, k * p // x[i].q AS release, ((k + 1) * p + x[i].q - 1) // x[i].q AS deadline FROM run, items WHERE t >= 0),
        r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('17 ' || '{{"doc_id":' || doc_id || ',"source":"' || source || '"}}')) - 1 AS source_rank FROM documents)
        SELECT doc_id, r.source, source_rank, source_rank // {BLOCK} AS block_no, (source_rank // {BLOCK} // q) * p + slot AS slot, (source_rank // {BLOCK} // q) * p + release AS release,
               (source_rank // {BLOCK} // q) * p + deadline AS deadline, ((source_rank // {BLOCK} // q) * p + slot) * {BLOCK} + source_rank % {BLOCK} AS mix_position
        FROM r JOIN plan ON r.source IS NOT DISTINCT FROM plan.source AND (source_rank // {BLOCK}) % q = k
    """,
    "op2_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
        sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+4], ' ') END AS s
               FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
        both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
        reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.y AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS y FROM reach GROUP BY 1) m ON m.x = d.doc_id
    """,
    "op4_line_dedup": f"""
        WITH p AS (SELECT row_number() OVER () AS id, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
        l AS (SELECT id, source, i, line, {_LINE} AS bare FROM (SELECT id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM p)),
        t AS (SELECT source, count(*) AS pages FROM p GROUP BY 1),
        f AS (SELECT source, bare FROM (SELECT DISTINCT id, source, bare FROM l WHERE bare <> '') JOIN t USING (source)
              GROUP BY source, bare, pages HAVING count(*) >= {LEAST_PAGES} AND count(*) > {RATIO} * pages),
        k AS (SELECT l.*, f.bare IS NULL AS stays FROM l LEFT JOIN f ON l.source = f.source AND l.bare = f.bare)
        SELECT p.doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_dropped_lines,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '') AS text
        FROM p JOIN k USING (id) GROUP BY id, p.doc_id
    """,
    "op5_url_rules": f"""
        WITH r(rule, verdict, h, p) AS (VALUES {_RULES}),
        u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        s AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                     coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path FROM u),
        b AS (SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS n
              FROM s LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM b WHERE n = 1
    """,
    "op12_collocations": f"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
        grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
                  FROM (SELECT lang, ws, k, unnest(range(1, greatest(len(ws) - k + 2, 1))) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
        f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS c FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
        cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND c >= {LEAST}),
        cuts AS (SELECT x.lang, x.phrase, a, cut, l.c AS l, r.c AS r, 1000000 * a * a // (l.c * r.c) AS score
                 FROM (SELECT *, array_to_string(ws[1:cut], ' ') AS lp, array_to_string(ws[cut + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)) x
                 JOIN f l ON l.lang = x.lang AND l.phrase = lp AND l.k = cut JOIN f r ON r.lang = x.lang AND r.phrase = rp AND r.k = x.k - cut),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (SELECT lang, p AS phrase, max(a) AS m FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS p FROM cand WHERE k = 3) GROUP BY ALL),
        kept AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
                 FROM best b LEFT JOIN longer USING (lang, phrase) WHERE m IS NULL OR 100 * m < {COVERED} * a)
        SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM kept JOIN totals USING (lang) WHERE rank <= {FIRST}
    """,
    "op13_vector_codes": f"""
        WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
                      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT i, vec_id, label, place, v[place * (len(v) // {PARTS}) + 1 : (place + 1) * (len(v) // {PARTS})] AS x FROM kept, (SELECT unnest(range({PARTS})) AS place)),
        b0 AS (SELECT place, i - 1 AS e, x AS c FROM parts WHERE i <= {ENTRIES}), {_ROUNDS}, last AS ({_assigned(f"b{ROUNDS}")}),
        rows_ AS (SELECT i, any_value(vec_id) AS vec_id, any_value(label) AS label, string_agg(printf('%02x', best.e), '' ORDER BY place) AS code, sum(best.d)::BIGINT AS error FROM last GROUP BY i)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY place, e)) FROM b{ROUNDS}) AS codebooks_sha256 FROM rows_
    """,
}
