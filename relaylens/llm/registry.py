"""Queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bottomk, bpe, dialogue, hnsw, htmltext, kdtree, langid, lemp, licences, partenum, quality, warc, winnow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        warc.op1_warc_transactions,
        kdtree.op2_kd_shards,
        bottomk.op3_bottom_k,
        htmltext.op4_html_consensus,
        quality.op5_quality_classifier,
        bpe.op6_byte_bpe,
        partenum.op7_partenum_join,
        winnow.op8_winnowing,
        langid.op9_language_id,
        licences.op10_licence_digest,
        hnsw.op11_hnsw_neighbours,
        dialogue.op12_conversation_repair,
        lemp.op13_lemp_negatives,
    )
}

ORACLE_SQL: dict[str, str] = {**licences.ORACLE_SQL, **warc.ORACLE_SQL, **lemp.ORACLE_SQL}
