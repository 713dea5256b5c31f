"""All registered queries with their SQL counterparts."""

from inkstrata.catalog import (  # noqa: F401
    corpus,
    examples,
    governance,
    ingest,
    metrics,
    retrieval,
    runlog,
    streams,
    tokenizer,
)
from inkstrata.catalog.base import ORACLES, QUERIES  # noqa: F401
