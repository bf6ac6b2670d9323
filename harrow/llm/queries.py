"""The queries of the operators in this subpackage, with their SQL checks."""

from harrow.llm import (
    bestfit,
    centroids,
    collocations,
    decontaminate,
    html,
    jaccard,
    language,
    packing,
    quality,
    repeats,
    secrets,
    topk,
    urls,
)
from harrow.session import ship_package

MODULES = (secrets, repeats, decontaminate, urls, topk, quality, packing, html, jaccard, language,
           bestfit, collocations, centroids)


def _shipped(query):
    """The query, once the workers have the package."""
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _shipped(query) for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
