"""The registered queries in DuckDB SQL, written from the definitions and not from the code."""

# White space and word characters of text cleaning, for RE2.
W = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
L = r"\p{L}\p{N}_"

# Tags at which an element of a page ends.
BLOCKS = (
    "p|div|section|article|main|body|html|header|aside|ul|ol|li|dl|dt|dd|table|caption|thead|tbody"
    "|tfoot|tr|td|th|pre|blockquote|figure|figcaption|form|fieldset|legend|address|details|summary|hr"
)


def clean(text: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(coalesce({text}, ''), "
        f"'([{L}])-[{W}]*\\n[{W}]*([{L}])', '\\1\\2', 'g'), '[{W}]+', ' ', 'g'))"
    )


def entities(text: str) -> str:
    for name, char in (
        ("&quot;", '"'),
        ("&apos;", "''"),
        ("&#39;", "''"),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&nbsp;", " "),
        ("&copy;", "©"),
        ("&middot;", "·"),
        ("&amp;", "&"),
    ):
        text = f"replace({text}, '{name}', '{char}')"
    return text


def _without_noise(page: str) -> str:
    page = f"regexp_replace({page}, '<!--.*?(-->|\\z)', '', 'gs')"
    for tag in ("script", "style"):
        page = f"regexp_replace({page}, '<{tag}\\b.*?(</{tag}\\s*>|\\z)', '', 'gis')"
    for tag in ("nav", "footer", "head", "title"):
        page = f"regexp_replace({page}, '<{tag}\\b.*?</{tag}\\s*>', '', 'gis')"
    page = f"""regexp_replace({page}, '<div class="ad">.*?</div>', '', 'gis')"""
    page = f"regexp_replace({page}, '<h1\\b[^<>]*>', chr(2) || 'h', 'gi')"
    page = f"regexp_replace({page}, '<h[2-6]\\b[^<>]*>', chr(2) || 's', 'gi')"
    blocks = f"(?:</?(?:{BLOCKS})\\b[^<>]*>|</h[1-6]\\s*>)"
    page = f"regexp_replace({page}, '{blocks}', chr(2) || 'p', 'gi')"
    page = f"regexp_replace({page}, '<br\\s*/?>', chr(10), 'gi')"
    return f"'p' || regexp_replace({page}, '<[^<>]*>', '', 'g')"


ELEMENTS = f"""
pieces AS (
    SELECT page_id, url, html,
        list_filter(string_split({_without_noise("html")}, chr(2)),
            lambda p: regexp_matches(p, '^[hsp][{W}]*[^{W}]')) AS ps
    FROM pages),
numbered AS (
    SELECT page_id, url, html, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS ix FROM pieces),
elements AS (
    SELECT page_id, url, html, ix, CAST(ix AS VARCHAR) AS id,
        CASE p[1] WHEN 'h' THEN 'title' WHEN 's' THEN 'heading' ELSE 'text' END AS type,
        {entities(f"regexp_replace(substr(p, 2), '^[{W}]+|[{W}]+$', '', 'g')")} AS content
    FROM numbered),
titles AS (
    SELECT page_id,
        nullif({clean(entities(r"regexp_extract(html, '<title\b[^<>]*>([^<]*)', 1, 'i')"))}, '')
            AS title
    FROM pages)
"""

METADATA = f"""
WITH {ELEMENTS}, firsts AS (
    SELECT page_id, {clean("arg_min(content, ix)")} AS summary
    FROM elements WHERE type = 'text' GROUP BY page_id)
SELECT page_id, title, coalesce(summary, '') AS summary,
    array_to_string(
        regexp_extract_all(html, '\\bhref="([^"]*)"', 1, 'i'), ' ') AS links
FROM pages JOIN titles USING (page_id) LEFT JOIN firsts USING (page_id)
"""

LINES = """
split AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS ls FROM documents),
lines AS (
    SELECT doc_id, lang, source, unnest(ls) AS text, generate_subscripts(ls, 1) - 1 AS ix
    FROM split),
chunks AS (
    SELECT doc_id || '_' || ix AS id, doc_id, ix, text, source AS title, lang AS authors
    FROM lines)
"""


def words(text: str) -> str:
    """The buckets of the words of a text, as a list."""
    return (
        f"list_transform(list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), "
        "lambda w: w <> ''), lambda w: ('0x' || substr(md5(w), 1, 4))::INT % 256)"
    )


def _counted(name: str, key: str, source: str, text: str) -> str:
    return f"""
{name}_words AS (SELECT {key}, unnest({words(text)}) AS bucket FROM {source}),
{name}_counts AS (
    SELECT {key}, bucket, count(*) AS n FROM {name}_words GROUP BY ALL),
{name}_norms AS (
    SELECT {key}, CAST(sum(n * n) AS BIGINT) AS norm2 FROM {name}_counts GROUP BY ALL)
"""


def _ranked(chunks: str = "chunks", before: str = LINES) -> str:
    return f"""{before},
questions AS (
    SELECT conv_id || '_' || turn AS qid, text AS question FROM conversations WHERE role = 'user'),
searched AS (SELECT * FROM {chunks}),
{_counted("c", "id", "searched", "text")},
{_counted("q", "qid", "questions", "question")},
dots AS (
    SELECT qid, id, sum(q_counts.n * c_counts.n) AS dot
    FROM q_counts JOIN c_counts USING (bucket) GROUP BY ALL),
scores AS (
    SELECT qid, id,
        round(dot / sqrt(CAST(q_norms.norm2 * c_norms.norm2 AS DOUBLE)), 6) AS score
    FROM dots JOIN q_norms USING (qid) JOIN c_norms USING (id)),
hits AS (
    SELECT qid, id, score,
        CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INT) AS rank
    FROM scores QUALIFY rank <= 5),
full_hits AS (
    SELECT qid, rank, id, text, authors, title, score FROM hits JOIN chunks USING (id)),
contexts AS (
    SELECT qid,
        string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
    FROM full_hits GROUP BY qid),
prompts AS (
    SELECT qid, question, context, concat(
        'You are a helpful research assistant.', chr(10),
        'Answer the user''s question using ONLY the provided context.', chr(10),
        'If the answer is not in the context, explain your best guess based on provided context.',
        chr(10), chr(10), 'CONTEXT:', chr(10), context, chr(10), chr(10),
        'USER QUESTION:', chr(10), question, chr(10)) AS prompt
    FROM questions JOIN contexts USING (qid))
"""


SOURCE_DOCS = """
source_docs AS (
    SELECT doc_id, 'f' || doc_id AS source_file_id, source AS title,
        CASE WHEN toxic = 0 THEN lang || ', ' || source ELSE '' END AS authors
    FROM labels JOIN documents USING (doc_id))
"""

NEW_CHUNKS = f"""{LINES}, {ELEMENTS},
new_chunks AS (
    SELECT id, regexp_replace(text, '[0-9]', '#', 'g') AS text, title, authors
    FROM chunks WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
    UNION ALL
    SELECT 'p' || page_id || '_' || id, content, url, NULL FROM elements)
"""

STATE = f"""
SELECT id, array_to_string(list_sort(v), ' ') AS words
FROM (SELECT id, {words("text")} AS v FROM new_chunks)
"""

KNN = """
WITH pairs AS (
    SELECT q.vec_id AS qid, c.vec_id AS id,
        CAST(q.embedding AS DOUBLE[]) AS a, CAST(c.embedding AS DOUBLE[]) AS b
    FROM embeddings q, embeddings c),
scores AS (
    SELECT qid, id, round(list_dot_product(a, b)
        / sqrt(list_dot_product(a, a) * list_dot_product(b, b)), 6) AS score
    FROM pairs)
SELECT qid, id, score,
    CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INT) AS rank
FROM scores QUALIFY rank <= 5
"""

# Cells around the mean directions of the labels; each vector is in the nearest, and asks in four.
PROBED = """
WITH given AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
        sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS size
    FROM embeddings),
parts AS (
    SELECT label, unnest(v) / size AS x, generate_subscripts(v, 1) AS k FROM given),
means AS (SELECT label, k, avg(x) AS x FROM parts GROUP BY ALL),
centers AS (SELECT label AS cell, list(x ORDER BY k) AS c FROM means GROUP BY label),
near AS (
    SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id
        ORDER BY list_dot_product(c, c) - 2 * list_dot_product(v, c) / size, cell) AS place
    FROM given, centers),
scores AS (
    SELECT q.vec_id AS qid, i.vec_id AS id,
        round(list_dot_product(a.v, b.v)
            / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 6) AS score
    FROM near q JOIN near i ON q.cell = i.cell AND q.place <= 4 AND i.place = 1
    JOIN given a ON a.vec_id = q.vec_id JOIN given b ON b.vec_id = i.vec_id)
SELECT qid, id, score,
    CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INT) AS rank
FROM scores QUALIFY rank <= 5
"""


def _cell_places(name: str, key: str) -> str:
    """For each row of counted words the cells, nearest first."""
    return f"""
{name}_near AS (
    SELECT {key}, cell, row_number() OVER (PARTITION BY {key} ORDER BY size2 - 2 * dot, cell) AS place
    FROM (
        SELECT {key}, cell, any_value(size2) AS size2,
            sum({name}_counts.n * x) / sqrt(any_value(norm2)) AS dot
        FROM {name}_counts JOIN {name}_norms USING ({key}) JOIN means USING (bucket)
        JOIN sizes USING (cell) GROUP BY {key}, cell))"""


# Questions and lines by the mean directions of the languages.
PROBE_RECALL = f"""
WITH {_ranked()},
units AS (
    SELECT authors AS cell, bucket, c_counts.n / sqrt(norm2) AS x
    FROM c_counts JOIN c_norms USING (id) JOIN chunks USING (id)),
lengths AS (
    SELECT authors AS cell, count(*) AS n FROM c_norms JOIN chunks USING (id) GROUP BY authors),
buckets AS (SELECT unnest(range(256)) AS bucket),
means AS (
    SELECT cell, bucket, coalesce(s.x, 0) / n AS x
    FROM lengths CROSS JOIN buckets
    LEFT JOIN (SELECT cell, bucket, sum(x) AS x FROM units GROUP BY ALL) s USING (cell, bucket)),
sizes AS (SELECT cell, sum(x * x) AS size2 FROM means GROUP BY cell),
{_cell_places("c", "id")},
{_cell_places("q", "qid")},
near_hits AS (
    SELECT nprobe, scores.qid, scores.id
    FROM (SELECT unnest([1, 2, 3]) AS nprobe, * FROM scores) scores
    JOIN c_near ON c_near.id = scores.id AND c_near.place = 1
    JOIN q_near ON q_near.qid = scores.qid AND q_near.cell = c_near.cell
    WHERE q_near.place <= nprobe
    QUALIFY row_number() OVER (PARTITION BY nprobe, scores.qid ORDER BY score DESC, scores.id) <= 5)
SELECT CAST(nprobe AS INT) AS nprobe, count(n.id) AS found, count(*) AS wanted,
    round(count(n.id) / count(*), 6) AS recall
FROM (SELECT unnest([1, 2, 3]) AS nprobe, qid, id FROM hits) LEFT JOIN near_hits n USING (nprobe, qid, id)
GROUP BY nprobe
"""

CLEANED = f"""
SELECT doc_id,
    {clean("regexp_replace(text, '([a-z]{5}) ', '\\1-' || chr(10), 'g')")} AS text
FROM documents
"""

FILTERED = "(SELECT * FROM chunks WHERE authors IN ('en', 'de'))"


def all_oracles() -> dict[str, str]:
    return {
        "q_scan_files": """
            SELECT page_id, CAST(strlen(html) + 1 AS BIGINT) AS length,
                md5(html || chr(10)) AS content_md5
            FROM pages""",
        "q_discover": """
            SELECT page_id, CAST(strlen(html) + 1 AS BIGINT) AS length
            FROM pages WHERE url NOT LIKE 'http://%'""",
        "q_optional_table": f"""
            WITH {LINES}, kept AS (
                SELECT '/docs/' || doc_id || '.txt_' || ix AS id,
                    doc_id IN (SELECT doc_id FROM labels) AS labelled
                FROM lines WHERE text NOT LIKE '% | %' AND regexp_matches(text, '[^{W}]'))
            SELECT 'absent' AS registry, id, false AS titled FROM kept
            UNION ALL SELECT 'present', id, labelled FROM kept""",
        "q_safe_name": "SELECT page_id, replace(replace(url, '/', ''), '.', '') AS name FROM pages",
        "q_norm_path": """
            SELECT page_id,
                CASE WHEN url LIKE 'https%' THEN url ELSE url || 'dbfs:' END AS doc_path
            FROM pages""",
        "q_author_names": f"WITH {SOURCE_DOCS} SELECT source_file_id, authors FROM source_docs",
        "q_clean_text": CLEANED,
        "q_clean_text_sql": CLEANED,
        "q_html_elements": f"WITH {ELEMENTS} SELECT page_id, id, type, content FROM elements",
        "q_markdown": f"""
            WITH {ELEMENTS}
            SELECT page_id, coalesce(string_agg(
                CASE WHEN type = 'title' THEN '# ' || content ELSE content END,
                chr(10) || chr(10) ORDER BY ix), '') AS markdown
            FROM pages LEFT JOIN elements USING (page_id) GROUP BY page_id""",
        "q_metadata": METADATA,
        "q_chunks": f"""
            WITH {LINES}, {SOURCE_DOCS}
            SELECT '/docs/' || doc_id || '.txt' AS doc_path, CAST(ix AS VARCHAR) AS chunk_id,
                {clean("l.text")} AS text, '/docs/' || doc_id || '.txt_' || ix AS id,
                s.title, s.authors, CAST(ix AS INT) AS element_ix
            FROM lines l LEFT JOIN source_docs s USING (doc_id)
            WHERE l.text NOT LIKE '% | %' AND regexp_matches(l.text, '[^{W}]')""",
        "q_chunks_sql": f"""
            WITH {LINES}
            SELECT 'dbfs:/docs/' || doc_id || '.txt' AS path, CAST(ix AS VARCHAR) AS chunk_id,
                {clean("text")} AS text
            FROM lines WHERE text NOT LIKE '% | %' AND regexp_matches(text, '[^{W}]')""",
        "q_pending": """
            SELECT '/docs/' || doc_id || '.txt' AS doc_path FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "q_new_files": """
            SELECT 'f' || doc_id AS source_file_id FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "q_exists": """
            SELECT 'f' || doc_id AS source_file_id,
                doc_id IN (SELECT doc_id FROM labels) AS "exists"
            FROM documents""",
        "q_registered": f"""
            WITH metadata AS ({METADATA})
            SELECT page_id, page_id AS file_page, title, summary, links,
                true AS not_known, true AS dated
            FROM metadata""",
        "q_listed": f"""
            WITH metadata AS ({METADATA}),
            named AS (
                SELECT page_id, 'f' || lpad(page_id::VARCHAR, 9, '0') AS file_id, url,
                    replace(replace(url, '/', ''), '.', '') AS name FROM pages)
            SELECT file_id, title, summary, links, true AS not_known, true AS dated,
                CASE WHEN row_number() OVER (PARTITION BY name
                        ORDER BY url NOT LIKE 'http://%', file_id) = 1
                    THEN name ELSE file_id || '-' || name END AS name
            FROM named JOIN metadata USING (page_id)""",
        "q_parsed_twice": f"""
            WITH {ELEMENTS}
            SELECT page_id, true AS dated,
                coalesce(string_agg(id || '|' || type || '|' || content, chr(10) ORDER BY ix), '')
                    AS elements
            FROM pages LEFT JOIN elements USING (page_id) GROUP BY page_id""",
        "q_reset": """
            SELECT 'source_docs' AS "table", count(*) AS "before", CAST(0 AS BIGINT) AS "after"
            FROM labels JOIN documents USING (doc_id)
            UNION ALL SELECT 'parsed_docs', count(*), 0 FROM documents""",
        "q_page_index": f"""
            WITH {ELEMENTS}, texts AS (
                SELECT page_id, id AS chunk_id, {clean("content")} AS text, title
                FROM elements JOIN titles USING (page_id) WHERE type = 'text')
            SELECT *, CAST(len({words("text")}) AS INT) AS n_words FROM texts""",
        "q_changes": f"""
            WITH {NEW_CHUNKS}, both_sides AS (
                SELECT id, o.id IS NOT NULL AS was, n.id IS NOT NULL AS is_now,
                    (o.text, o.title, o.authors) IS DISTINCT FROM (n.text, n.title, n.authors)
                        AS differs
                FROM chunks o FULL JOIN new_chunks n USING (id))
            SELECT id, CASE WHEN NOT was THEN 'insert' WHEN NOT is_now THEN 'delete'
                ELSE 'update' END AS op
            FROM both_sides WHERE NOT was OR NOT is_now OR differs""",
        "q_key_violations": f"""
            WITH {LINES}, keyed AS (SELECT md5(nullif(text, '')) AS id FROM lines)
            SELECT id, count(*) AS n FROM keyed GROUP BY id HAVING count(*) > 1 OR id IS NULL""",
        "q_embed": f"""
            WITH {LINES}, {_counted("c", "id", "chunks", "text")}
            SELECT id, bucket, n, norm2 FROM c_counts JOIN c_norms USING (id)""",
        "q_sync": f"WITH {NEW_CHUNKS} {STATE}",
        "q_knn_embeddings": KNN,
        "q_top_k": f"WITH {_ranked()} SELECT * FROM full_hits",
        "q_top_k_blocks": f"WITH {_ranked()} SELECT qid, rank, id, score FROM hits",
        "q_top_k_filtered": f"WITH {_ranked(FILTERED)} SELECT * FROM full_hits",
        "q_top_k_cells": KNN,
        "q_top_k_probed": PROBED,
        "q_cells_followed": f"WITH {_ranked('new_chunks', NEW_CHUNKS)} SELECT qid, rank, id, score FROM hits",
        "q_probe_recall": PROBE_RECALL,
        "q_context": f"WITH {_ranked()} SELECT * FROM contexts",
        "q_prompts": f"WITH {_ranked()} SELECT * FROM prompts",
        "q_indexed_prompts": f"WITH {_ranked(FILTERED)} SELECT qid, prompt FROM prompts",
        "q_cell_prompts": f"WITH {_ranked()} SELECT qid, prompt FROM prompts",
        "q_stream_parse": f"WITH {ELEMENTS} SELECT page_id, id, type, content FROM elements",
        "q_stream_sync": f"""
            WITH {ELEMENTS}, texts AS (
                SELECT page_id, id AS chunk_id, {words(clean("content"))} AS v
                FROM elements
                WHERE type = 'text' AND (url NOT LIKE 'http://%' OR id = '0'))
            SELECT page_id, chunk_id, array_to_string(list_sort(v), ' ') AS words
            FROM texts""",
    }
