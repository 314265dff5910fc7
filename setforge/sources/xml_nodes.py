"""XML texts as rows of nodes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

NODE_SCHEMA = (
    "doc_id bigint, side int, node bigint, parent bigint, depth int, path string, name string, kids int, "
    "attrs array<struct<name: string, value: string>>"
)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _walk(text: str) -> Iterator[tuple]:
    """Preorder nodes of one document; local names only, attributes by name."""
    todo, number = [(ElementTree.fromstring(text), None, 0, "")], 0
    while todo:
        element, parent, depth, above = todo.pop()
        path = f"{above}/{_local(element.tag)}"
        attrs = sorted((_local(k), v) for k, v in element.attrib.items())
        yield number, parent, depth, path, _local(element.tag), len(element), [{"name": k, "value": v} for k, v in attrs]
        todo.extend((child, number, depth + 1, path) for child in reversed(element))
        number += 1


def _nodes(batch: pd.DataFrame) -> Iterator[tuple]:
    for doc_id, side, text in zip(batch.doc_id, batch.side, batch.xml):
        if text is None:
            continue
        try:
            yield from ((doc_id, side, *n) for n in _walk(text))
        except ElementTree.ParseError as e:
            yield doc_id, side, None, None, None, None, f"not XML: {e}", None, None


def xml_nodes(docs: DataFrame, rows: int = 20_000) -> DataFrame:
    """Shred ``(doc_id, side, xml)`` into one row per element; text between elements is left out.

    A text that does not parse gives one row without node, whose name tells why. Rows leave in
    frames of ``rows`` at most, however many elements a text or a batch holds.
    """

    def shred(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "side", "node", "parent", "depth", "path", "name", "kids", "attrs"]
        for batch in batches:
            nodes = _nodes(batch)
            while held := list(islice(nodes, rows)):
                frame = pd.DataFrame(held, columns=columns)
                yield frame.astype(dict.fromkeys(["parent", "node", "depth", "kids"], "Int64"))

    return docs.select("doc_id", "side", "xml").mapInPandas(shred, NODE_SCHEMA)
