"""Local-name paths over a tree in which every element is an array of repeats."""

from __future__ import annotations

from .text import clean, clean_parsed


def first_node(node: str, path: str) -> str:
    """First repeat at each level of ``a/b/c``, NULL when any level is absent."""
    for part in path.split("/"):
        node = f"get({node}.`{part}`, 0)"
    return node


def first_text(node: str, path: str) -> str:
    """Trimmed text of the first match, NULL when absent or blank."""
    return clean_parsed(first_node(node, path))


def every_node(nodes: str, path: str) -> str:
    """All matches of a path below an array of nodes, in document order; never NULL."""
    nodes = f"coalesce({nodes}, array())"
    for part in path.split("/"):
        nodes = f"flatten(transform({nodes}, node -> coalesce(node.`{part}`, array())))"
    return nodes


def every_text(node: str, path: str) -> str:
    """Texts of all repeats of the last step below the first match of the steps before it."""
    *parents, leaf = path.split("/")
    if parents:
        node = first_node(node, "/".join(parents))
    texts = f"transform(coalesce({node}.`{leaf}`, array()), t -> {clean('t')})"
    return f"filter({texts}, t -> t is not null)"
