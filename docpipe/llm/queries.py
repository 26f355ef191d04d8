"""The registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from collections.abc import Callable

from docpipe.llm import (
    chat_trees,
    decontaminate,
    fill_middle,
    merkle,
    mixing,
    parity_join,
    permutation,
    quality,
    secrets,
    substrings,
    tokens,
    toxicity,
    url_filter,
)


def queries() -> dict[str, Callable]:
    return {
        "op1_url_filter": url_filter.query,
        "op2_quality": quality.query,
        "op3_toxicity": toxicity.query,
        "op4_parity_join": parity_join.query,
        "op5_chat_trees": chat_trees.query,
        "op6_decontaminate": decontaminate.query,
        "op7_mixing": mixing.query,
        "op8_token_counts": tokens.query,
        "op9_substrings": substrings.query,
        "op10_secrets": secrets.query,
        "op11_merkle": merkle.query,
        "op12_fill_middle": fill_middle.query,
        "op13_permutation": permutation.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": url_filter.oracle(),
        "op2_quality": quality.oracle(),
        "op4_parity_join": parity_join.oracle(),
        "op5_chat_trees": chat_trees.oracle(),
        "op11_merkle": merkle.oracle(),
        "op12_fill_middle": fill_middle.oracle(),
    }
