"""Registered queries of this folder, one for each operator, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.decontaminate import find_contamination
from termloom.llm.labelled import fold
from termloom.llm.license_scan import scan_licenses
from termloom.llm.line_dedup import remove_boilerplate
from termloom.llm.manifest import digest_of, fold_proofs, merkle_proofs
from termloom.llm.neighbours import nearest_neighbours
from termloom.llm.packing import pack_documents, with_groups
from termloom.llm.quality import fit_quality, score_quality
from termloom.llm.ranked_search import ranked_search
from termloom.llm.simhash import simhash_components
from termloom.llm.token_files import read_token_files, write_token_files
from termloom.llm.toxicity import fit_toxicity, score_toxicity
from termloom.llm.vectors import vector_duplicates
from termloom.llm.warc import read_warc, write_warc
from termloom.sinks.tables import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    folder = shared_folder(spark)
    write_warc(_table(spark, sf_dir, "pages"), folder, record_id="page_id", uri="url", payload="html")
    records = read_warc(spark, folder)
    revisit = F.col("record_type") == "revisit"
    return records.select(
        F.col("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        F.when(revisit, F.col("digest")).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that three sources or more share."""
    out = remove_boilerplate(_table(spark, sf_dir, "documents"), removed="n_removed")
    return out.select("doc_id", "text", "n_removed")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("bigint").alias("n_base"),
        F.array_min("base_places").alias("first_word"),
        F.array_max("base_places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op4_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document encoded, written in id order and read back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    folder = shared_folder(spark)
    write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizer)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    groups = simhash_components(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into bins of 2048 words, one of a source and of a near-duplicate group each."""
    return pack_documents(with_groups(_table(spark, sf_dir, "documents")))


def op7_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors with a cosine of 0.9 or more."""
    return vector_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = find_contamination(documents, _table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _classified(scores: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scores.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from four fifths of the labels."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(documents, _table(spark, sf_dir, "labels"), learn=fold(F.col("doc_id"), 5) != 0)
    return _classified(score_toxicity(documents, model), 5, 0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from two thirds of the labels."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(documents, _table(spark, sf_dir, "labels"), learn=fold(F.col("doc_id"), 3) != 1)
    return _classified(score_quality(documents, model, keep=["doc_id"]), 3, 1)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search(documents, _table(spark, sf_dir, "benchmark"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id 20 divides."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, folded again with some of the documents changed."""
    documents = _table(spark, sf_dir, "documents")
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    # A decimal, so that the largest long has a successor.
    longer = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    tampered = F.coalesce(fold(F.col("doc_id"), 7) == 0, F.lit(False))
    changed = F.when(tampered, digest_of(*parts[:3], longer, parts[4]))
    leaves = documents.select("doc_id", "lang", digest_of(*parts).alias("leaf"), changed.alias("changed"))
    proofs = merkle_proofs(leaves).withColumn("now", F.coalesce("changed", "leaf"))
    return fold_proofs(proofs, leaf="now").select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_warc": op1_warc,
    "op2_line_dedup": op2_line_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_token_files": op4_token_files,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_vector_duplicates": op7_vector_duplicates,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_ranked_search": op11_ranked_search,
    "op12_neighbours": op12_neighbours,
    "op13_manifest": op13_manifest,
}

# Five hexadecimal digits are four of base 32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_OP1 = f"""
    WITH hashed AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
    ),
    digested AS (
        SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(
            list_transform([15, 10, 5, 0], lambda shift: substr('{_BASE32}',
                1 + ((('0x' || substr(hex, 1 + 5 * i::INT, 5))::INT >> shift) & 31), 1)), '')), '') AS payload_digest
        FROM hashed
    ),
    latest AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS latest FROM digested)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> latest THEN latest END AS refers_to
    FROM latest
"""

_OP2 = r"""
    WITH listed AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS own FROM documents),
    lines AS (SELECT doc_id, source, unnest(own) AS line, generate_subscripts(own, 1) AS n FROM listed),
    plain AS (
        SELECT *, trim(regexp_replace(lower(line), '[ \t\n\v\f\r]+', ' ', 'g')) AS key FROM lines
    ),
    long AS (SELECT * FROM plain WHERE length(key) - length(replace(key, ' ', '')) >= 2),
    spread AS (SELECT key, min((doc_id, n)) AS first FROM long GROUP BY key HAVING count(DISTINCT source) >= 3),
    gone AS (
        SELECT doc_id, list(n) AS ns FROM long JOIN spread USING (key) WHERE (doc_id, n) <> first GROUP BY doc_id
    )
    SELECT doc_id, coalesce(len(ns), 0)::BIGINT AS n_removed,
           CASE WHEN ns IS NULL THEN text
                ELSE coalesce(array_to_string(list_filter(own, lambda line, i: NOT list_contains(ns, i)), chr(10)), '')
           END AS text
    FROM listed LEFT JOIN gone USING (doc_id)
"""

_OP7 = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.9
    ),
    reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, b)::BIGINT AS component_id,
           vec_id = least(vec_id, b) AS kept
    FROM embeddings LEFT JOIN counts ON vec_id = counts.a LEFT JOIN least ON vec_id = least.a
"""


def _words(text: str) -> str:
    lowered = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all(coalesce({lowered}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_OP8 = f"""
    WITH items AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
    sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS gram
        FROM sized
    ),
    docs AS (SELECT doc_id, {_words("text")} AS w FROM documents),
    starts AS (
        SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows)
    ),
    grams AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram FROM starts),
    found AS (SELECT doc_id, k, i, item_id FROM grams JOIN windows USING (k, gram)),
    hits AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM found) GROUP BY doc_id
    ),
    names AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(item_list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)
"""

_OP11 = f"""
    WITH docs AS (SELECT doc_id, {_words("text")} AS w FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM docs) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    total AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs WHERE len(w) > 0),
    sized AS (SELECT doc_id, 50 + (50 * len(w) * n_docs) // n_terms AS m FROM docs, total),
    weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM df, total),
    terms AS (SELECT DISTINCT item_id, unnest({_words("text")}) AS term FROM benchmark),
    scores AS (
        SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
        FROM terms JOIN weights USING (term) JOIN tf USING (term) JOIN sized USING (doc_id) GROUP BY ALL
    ),
    ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scores WHERE score > 0
    )
    SELECT * FROM ranked WHERE rank <= 50
"""


def _leaf(n_chars: str) -> str:
    def part(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# The polynomial of crc32, bit by bit over the digits of the id.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, _: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))))"""
_OP13 = f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
               CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS changed
        FROM documents
    ),
    places AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size
        FROM leaves
    ),
    nodes AS (
        SELECT tree, 0 AS level, place, size, leaf AS hash FROM places
        UNION ALL
        SELECT tree, level + 1, place // 2, any_value(size + 1) // 2, sha256(string_agg(hash, '' ORDER BY place))
        FROM nodes WHERE size > 1 GROUP BY tree, level, place // 2
    ),
    subroots AS (
        SELECT tree, level AS height, hash AS subroot, row_number() OVER (ORDER BY tree::BLOB) - 1 AS place, count(*) OVER () AS size
        FROM nodes WHERE size = 1
    ),
    tops AS (
        SELECT 0 AS level, place, size, subroot AS hash FROM subroots
        UNION ALL
        SELECT level + 1, place // 2, any_value(size + 1) // 2, sha256(string_agg(hash, '' ORDER BY place))
        FROM tops WHERE size > 1 GROUP BY level, place // 2
    ),
    root AS (SELECT hash AS root FROM tops WHERE size = 1),
    rows AS (
        SELECT doc_id, p.tree, p.place, p.size, leaf, coalesce(changed, leaf) AS now, height, subroot, root, s.place AS top, s.size AS tops
        FROM places p JOIN subroots s ON p.tree = s.tree, root
    ),
    ways AS (
        SELECT r.tree, r.place, n.level, n.hash FROM rows r JOIN nodes n ON n.tree = r.tree AND n.place = xor(r.place >> n.level, 1)
        WHERE n.level < r.height
        UNION ALL
        SELECT r.tree, r.place, r.height + t.level, t.hash FROM rows r JOIN tops t ON t.place = xor(r.top >> t.level, 1)
    ),
    digests AS (SELECT tree, place, sha256(string_agg(hash, '' ORDER BY level)) AS proof_sha256 FROM ways GROUP BY tree, place),
    folds AS (
        SELECT tree, place, 0 AS level, height, top, size, tops, now FROM rows
        UNION ALL
        SELECT f.tree, f.place, f.level + 1, height, top, size, tops,
               CASE WHEN w.hash IS NULL THEN sha256(now)
                    WHEN (CASE WHEN f.level < height THEN f.place >> f.level ELSE top >> (f.level - height) END) % 2 = 1 THEN sha256(w.hash || now)
                    ELSE sha256(now || w.hash) END
        FROM folds f LEFT JOIN ways w ON f.tree = w.tree AND f.place = w.place AND f.level = w.level
        WHERE f.level < height OR (tops - 1) >> (f.level - height) > 0
    ),
    folded AS (SELECT tree, place, arg_max(now, level) AS folded_root FROM folds GROUP BY tree, place)
    SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM rows LEFT JOIN digests USING (tree, place) JOIN folded USING (tree, place)
"""

# The others compute hashes, models, files or a packing that SQL does not have.
ORACLES: dict[str, str] = {
    "op1_warc": _OP1,
    "op2_line_dedup": _OP2,
    "op7_vector_duplicates": _OP7,
    "op8_decontamination": _OP8,
    "op11_ranked_search": _OP11,
    "op13_manifest": _OP13,
}
