"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import bpe, html, langid, mil, packing, rules, sharding, simhash, tiff, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_tiff": tiff.op1_tiff,
        "op2_feistel": sharding.op2_feistel,
        "op3_packing": packing.op3_packing,
        "op4_warc": warc.op4_warc,
        "op5_rules": rules.op5_rules,
        "op6_bpe": bpe.op6_bpe,
        "op7_mil": mil.op7_mil,
        "op8_html": html.op8_html,
        "op9_simhash": simhash.op9_simhash,
        "op10_langid": langid.op10_langid,
    }


def oracle_sql() -> dict[str, str]:
    """Checksums beyond MD5 and SHA, tokenizers and learned models have no DuckDB SQL; tests hold the other queries against plain versions."""
    return {
        "op4_warc": """
            WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
            f AS (SELECT *, strlen(body) AS n, min(page_id) OVER (PARTITION BY body) AS first FROM p),
            r AS (SELECT *, n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
            SELECT page_id, n AS payload_bytes, sha256(body) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM r""",
    }
