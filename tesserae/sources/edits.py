"""Edits of YAML files that leave every other byte where it is: order, comments, quotes.

An edit names a place by its keys. The file's syntax tree says where that place stands in the text; what comes out is a
script, one row per change (file, line, start, end, text): characters to replace and what by. Applying a script is a second
step, so it can be read, counted and filtered first. After a file was edited it is read again: if it does not say what it
should, its edits are refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from textwrap import indent as indented

import pandas as pd
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCRIPT = "file string, edit int, line int, start int, end int, text string, error string"
ACTIONS = ("put", "append", "remove")


def _find(node: yaml.Node | None, key: str) -> tuple[yaml.Node, yaml.Node] | None:
    return next(((k, v) for k, v in node.value if k.value == key), None) if isinstance(node, yaml.MappingNode) else None


def _end(node: yaml.Node, text: str) -> int:
    """Where the last line of a node ends, its line end included. A block's own end mark lies behind comments that follow."""
    while isinstance(node, (yaml.MappingNode, yaml.SequenceNode)) and not node.flow_style and node.value:
        node = node.value[-1][1] if isinstance(node, yaml.MappingNode) else node.value[-1]
    at = node.end_mark.index
    if isinstance(node, yaml.ScalarNode) and node.style in ("|", ">"):
        while at > node.start_mark.index and text[at - 1] in " \t":
            at -= 1
        return at
    cut = text.find("\n", at)
    return len(text) if cut < 0 else cut + 1


def _dumped(value, column: int) -> str:
    return indented(yaml.safe_dump(value, allow_unicode=True, sort_keys=False, width=1_000), " " * column)


def _inline(value) -> str:
    return yaml.safe_dump(value, allow_unicode=True, sort_keys=False, width=1_000_000, default_flow_style=True).removesuffix("\n").removesuffix("\n...")


def change(text: str, action: str, keys: list[str], value=None) -> tuple[int, int, str] | None:
    """(start, end, new text) of one edit; nothing if the file says so already. Raises where there is no such place.

    put sets a key, making what is missing above it; append adds to a list unless it is there; remove takes a key with all below it.
    """
    root = yaml.compose(text, Loader=yaml.SafeLoader)
    data = yaml.safe_load(text)
    node, above = root, []
    for depth, key in enumerate(keys):
        pair = _find(node, key)
        if pair is None:
            break
        above.append(pair)
        node, data = pair[1], data[key] if key in data else data[yaml.safe_load(pair[0].value)]
    else:
        depth = len(keys)
    missing = keys[depth:]
    if action == "remove":
        if missing:
            return None
        pair, parent = above[-1], above[-2][1] if len(above) > 1 else root
        if parent.flow_style:
            raise ValueError("a key inside { } is not removed")
        if len(parent.value) == 1:
            raise ValueError("the last key of a mapping is not removed")
        start = text.rfind("\n", 0, pair[0].start_mark.index) + 1
        return start, _end(pair[1], text), ""
    new = value if action == "put" else [value]
    if not missing:
        if action == "append" and isinstance(data, list):
            if value in data:
                return None
            if node.flow_style or not data:
                at = node.end_mark.index - 1
                return at, at, (", " if data else "") + _inline(value)
            at = _end(node, text)
            return at, at, ("" if text[at - 1] == "\n" else "\n") + _dumped([value], node.start_mark.column)
        if data == new:
            return None
        if action == "append" and data is not None:
            raise ValueError(f"{'.'.join(keys)} is no list")
        key = above[-1][0]
        if isinstance(node, yaml.ScalarNode) and node.style not in ("|", ">") and not isinstance(new, (dict, list)):
            gap = "" if text[node.start_mark.index - 1 : node.start_mark.index] in (" ", "\n") else " "
            return node.start_mark.index, node.end_mark.index, gap + _inline(new)
        if len(above) > 1 and above[-2][1].flow_style:
            return node.start_mark.index, node.end_mark.index, _inline(new)
        start = text.rfind("\n", 0, key.start_mark.index) + 1
        return start, _end(node, text), _dumped({yaml.safe_load(key.value) if key.style is None else key.value: new}, key.start_mark.column)
    for key in reversed(missing[1:]):
        new = {key: new}
    if root is None:
        return len(text), len(text), ("" if not text or text[-1] == "\n" else "\n") + _dumped({missing[0]: new}, 0)
    if isinstance(node, yaml.MappingNode) and node.value and not node.flow_style:
        at = _end(node, text)
        return at, at, ("" if text[at - 1] == "\n" else "\n") + _dumped({missing[0]: new}, node.value[0][0].start_mark.column)
    if isinstance(node, yaml.MappingNode) and node.flow_style and node.value:
        at = node.end_mark.index - 1
        return at, at, ", " + _inline({missing[0]: new})[1:-1]
    if data in (None, {}) and above:
        below = _dumped({missing[0]: new}, above[-1][0].start_mark.column + 2)
        if isinstance(node, yaml.MappingNode):  # { }
            return node.start_mark.index, node.end_mark.index, "\n" + below.removesuffix("\n")
        at = _end(node, text)
        return at, at, ("" if text[at - 1] == "\n" else "\n") + below
    raise ValueError(f"{'.'.join(keys[:depth])} is no mapping")


def _expected(data, action: str, keys: list[str], value):
    """What the file should say after an edit."""
    if action == "remove" and len(keys) == 1:
        return {k: v for k, v in data.items() if k != keys[0]}
    if not keys:
        return value if action == "put" else (data or []) if value in (data or []) else [*(data or []), value]
    held = dict(data or {})
    name = next((k for k in held if str(k) == keys[0]), keys[0])
    if action == "remove" and name not in held:
        return held
    held[name] = _expected(held.get(name), action, keys[1:], value)
    return held


def script(text: str, edits: list[tuple[str, list[str], object]]) -> list[tuple]:
    """(edit, line, start, end, new text, error) of the edits of one file, each as the file stands after those before it; lines
    count from 1. An edit without effect has no row."""
    out = []
    for n, (action, keys, value) in enumerate(edits):
        try:
            if action not in ACTIONS or not keys:
                raise ValueError(f"{action} is not known" if keys else "no place")
            made = change(text, action, keys, value)
            if made is None:
                continue
            start, end, new = made
            edited = text[:start] + new + text[end:]
            if yaml.safe_load(edited) != _expected(yaml.safe_load(text), action, keys, value):
                raise ValueError(f"{'.'.join(keys)} cannot be edited in place")
            out.append((n, text.count("\n", 0, start) + 1, start, end, new, None))
            text = edited
        except (ValueError, yaml.YAMLError, AttributeError, TypeError) as e:
            out.append((n, None, None, None, None, str(e)[:500] or type(e).__name__))
    return out


def scripted(files: DataFrame, edits: DataFrame) -> DataFrame:
    """files (file, text), edits (file, ord, action, keys, value as JSON) -> SCRIPT: what each edit does, in order, or why it cannot
    be done. Each file is met by its own edits alone."""

    def run(texts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for file, text in zip(texts["file"], texts["text"], strict=True):
            asked = asked.sort_values("ord", kind="stable")
            found = script(text or "", [(a, list(k), None if v is None else json.loads(v)) for a, k, v in zip(asked["action"], asked["keys"], asked["value"], strict=True)])
            rows += [(file, *r) for r in found]
        frame = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in SCRIPT.split(", ")])
        return frame.astype({c: "Int32" for c in ("edit", "line", "start", "end")})

    asked = edits.select("file", "ord", "action", "keys", "value")
    return files.select("file", "text").groupBy("file").cogroup(asked.groupBy("file")).applyInPandas(run, SCRIPT)


def applied(files: DataFrame, scripts: DataFrame) -> DataFrame:
    """(file, text, changes) of the files that a script changes: what sinks.write_files puts in place."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for text, steps in zip(batch["text"], batch["steps"], strict=True):
                for s in steps:
                    text = text[: s["start"]] + s["new"] + text[s["end"] :]
                texts.append(text)
            yield pd.DataFrame({"file": batch["file"], "text": texts, "changes": batch["changes"]})

    done = scripts.where("error IS NULL").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("edit", "start", "end", F.col("text").alias("new")))).alias("steps"), F.count("*").alias("changes"))
    return files.select("file", "text").join(done, "file").mapInPandas(run, "file string, text string, changes long")


def counts(scripts: DataFrame) -> DataFrame:
    """(file, changes, refused): how many edits change a file, and how many cannot be done."""
    return scripts.groupBy("file").agg(F.count_if(F.col("error").isNull()).alias("changes"), F.count_if(F.col("error").isNotNull()).alias("refused"))
