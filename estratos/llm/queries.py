"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from estratos.llm import (
    decontamination, hosts, jaccard, languages, lexical, merkle, mixing, oracles, quality, rules, sharding, substrings,
    vectors, warc,
)

QUERIES = {
    fn.__name__: fn
    for fn in (
        quality.op1_quality_network,
        sharding.op2_hypergeometric_shards,
        decontamination.op3_winnowing,
        rules.op4_weak_supervision,
        languages.op5_mixture_languages,
        hosts.op6_host_reputation,
        warc.op7_warc_members,
        substrings.op8_repeated_passages,
        mixing.op9_source_mix,
        jaccard.op10_jaccard_components,
        lexical.op11_block_max_search,
        vectors.op12_kd_tree_search,
        merkle.op13_merkle_manifest,
    )
}

ORACLES: dict[str, str] = {
    decontamination.op3_winnowing.__name__: decontamination.ORACLE,
    hosts.op6_host_reputation.__name__: hosts.ORACLE,
    mixing.op9_source_mix.__name__: mixing.ORACLE,
    warc.op7_warc_members.__name__: oracles.WARC,
    substrings.op8_repeated_passages.__name__: oracles.PASSAGES,
    jaccard.op10_jaccard_components.__name__: oracles.COMPONENTS,
    lexical.op11_block_max_search.__name__: lexical.ORACLE,
    vectors.op12_kd_tree_search.__name__: vectors.ORACLE,
    merkle.op13_merkle_manifest.__name__: merkle.ORACLE,
}
