"""The registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from earshot.llm.digest import op5_digest
from earshot.llm.langid import op4_language
from earshot.llm.lm import op2_lm_score
from earshot.llm.main_text import op3_main_text
from earshot.llm.manifest import SQL as MANIFEST_SQL
from earshot.llm.manifest import op13_manifest
from earshot.llm.mixing import op9_mixing
from earshot.llm.packing import op10_packing
from earshot.llm.quality import SQL as QUALITY_SQL
from earshot.llm.quality import op7_quality
from earshot.llm.repeats import op8_repeats
from earshot.llm.secrets import op6_secret_scan
from earshot.llm.sharding import op12_sharding
from earshot.llm.simhash import op1_simhash
from earshot.llm.trie import SQL as TRIE_SQL
from earshot.llm.trie import op11_prefix_trie

QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_lm_score,
        op3_main_text,
        op4_language,
        op5_digest,
        op6_secret_scan,
        op7_quality,
        op8_repeats,
        op9_mixing,
        op10_packing,
        op11_prefix_trie,
        op12_sharding,
        op13_manifest,
    )
}
ORACLE_SQL = {
    "op7_quality": QUALITY_SQL,
    "op11_prefix_trie": TRIE_SQL,
    "op13_manifest": MANIFEST_SQL,
}
