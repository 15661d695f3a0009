"""The registered queries of this subpackage and the SQL they must agree with.

Packing, toxicity, license templates and languages have no SQL form; tests hold them against brute force or held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codeloom.llm import chat, decontaminate, exact, langid, licenses, linededup, manifest, minhash, nearest, packing, repair, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": minhash.query,
    "op2_packing": packing.query,
    "op3_urlfilter": urlfilter.query,
    "op4_toxicity": toxicity.query,
    "op5_decontaminate": decontaminate.query,
    "op6_chat": chat.query,
    "op7_linededup": linededup.query,
    "op8_licenses": licenses.query,
    "op9_exact": exact.query,
    "op10_langid": langid.query,
    "op11_nearest": nearest.query,
    "op12_repair": repair.query,
    "op13_manifest": manifest.query,
}

SQL: dict[str, str] = {
    "op1_minhash": minhash.SQL,
    "op3_urlfilter": urlfilter.SQL,
    "op5_decontaminate": decontaminate.SQL,
    "op6_chat": chat.SQL,
    "op7_linededup": linededup.SQL,
    "op9_exact": exact.SQL,
    "op11_nearest": nearest.SQL,
    "op12_repair": repair.SQL,
    "op13_manifest": manifest.SQL,
}
