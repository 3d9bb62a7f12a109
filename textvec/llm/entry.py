"""The queries of this subpackage, for registration, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from textvec.llm import angular, chat, cover_tree, line_dedup
from textvec.llm import queries as _queries

QUERIES = {name: query for name, query in vars(_queries).items() if name.startswith("op")}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE_SQL = {
    "op6_deletion_neighbourhood": line_dedup.ORACLE,
    "op8_snapshot_collapse": chat.ORACLE,
    "op11_angular_negatives": angular.ORACLE,
    "op13_cover_tree_search": cover_tree.ORACLE,
}
