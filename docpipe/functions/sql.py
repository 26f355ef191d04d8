"""The text operators as SQL functions of the session."""

from pyspark.sql import SparkSession

from docpipe import schemas
from docpipe.functions.text import LINE_HYPHEN, SPACE


def register(spark: SparkSession) -> None:
    """Create `clean_chunk(text)`, `chunk_list(json)` and the table function `extract_chunks(json)`.

    All are plain SQL that Spark inlines into the calling query. Spark runs a table function on a
    column as a join of the table with its own different texts, which shuffles them; on large
    tables select `chunk_list(json)` and explode it, which gives the same rows where they lie.
    """
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION clean_chunk(t STRING) RETURNS STRING
        RETURN trim(regexp_replace(
            regexp_replace(coalesce(t, ''), r'{LINE_HYPHEN}', '$1$2'),
            r'[{SPACE}]+', ' '))
        """
    )
    options = ", ".join(f"'{k}', '{v}'" for k, v in schemas.JSON_OPTIONS.items())
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION chunk_list(parsed_content STRING)
        RETURNS ARRAY<STRUCT<element_ix: INT, chunk_id: STRING, content: STRING>>
        RETURN transform(
            filter(
                transform(
                    from_json(
                        parsed_content, '{schemas.PARSED_CONTENT.simpleString()}', map({options})
                    ).document.elements,
                    (e, i) -> named_struct('pos', i, 'e', e)
                ),
                p -> p.e.type = 'text' AND p.e.content RLIKE r'[^{SPACE}]'
            ),
            p -> named_struct(
                'element_ix', p.pos,
                'chunk_id', coalesce(nullif(p.e.id, ''), concat('e', p.pos)),
                'content', p.e.content
            )
        )
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION extract_chunks(parsed_content STRING)
        RETURNS TABLE (element_ix INT, chunk_id STRING, content STRING)
        RETURN
            SELECT pos, coalesce(nullif(e.id, ''), concat('e', pos)), e.content
            FROM (SELECT from_json(
                parsed_content, '{schemas.PARSED_CONTENT.simpleString()}', map({options})
                ) AS parsed) AS p,
                LATERAL posexplode(p.parsed.document.elements) AS t(pos, e)
            WHERE e.type = 'text' AND e.content RLIKE r'[^{SPACE}]'
        """
    )
