"""File trees as tables of ``(path, content)``: placeholder replacement and retaining sync."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from maskwright.functions.names import is_text_file, top_level

# Tokens replaced in an application folder, and names a sync never deletes.
PLACEHOLDERS = {
    "MODEL_REPO_ID": "$MODEL_REPO_ID",
    "MODEL_REPO_URL": "$MODEL_REPO_URL",
    "MODEL_VERSION": "$MODEL_VERSION",
}
RETAINED = (".gitattributes", ".git")


def placeholder_values(repo_id: str, repo_url: str, version: str,
                       tokens: Mapping[str, str] | None = None) -> dict[str, str]:
    """Token to value, in replacement order. A custom token map must name all three."""
    chosen = PLACEHOLDERS if tokens is None else tokens
    missing = [k for k in PLACEHOLDERS if k not in chosen]
    if missing:
        raise ValueError(f"placeholders lack {', '.join(missing)}")
    values = {"MODEL_REPO_ID": repo_id, "MODEL_REPO_URL": repo_url, "MODEL_VERSION": version}
    return {chosen[name]: value for name, value in values.items()}


def replace_tokens(text: Column, values: Mapping[str, str]) -> Column:
    """Literal replacements one after another: a later token may match text put in by an earlier one."""
    for token, value in values.items():
        text = F.replace(text, F.lit(token), F.lit(value))
    return text


def replace_placeholders(files: DataFrame, values: Mapping[str, str], path: str = "path",
                         content: str = "content") -> DataFrame:
    """Replace tokens in the text files of a tree; files of other types pass unchanged."""
    original = F.col(content)
    if files.schema[content].dataType.simpleString() == "binary":
        replaced = F.encode(replace_tokens(F.decode(original, "UTF-8"), values), "UTF-8")
    else:
        replaced = replace_tokens(original, values)
    return files.withColumn(content, F.when(is_text_file(F.col(path)), replaced).otherwise(original))


def sync(existing: DataFrame, incoming: DataFrame, path: str = "path",
         retained: Sequence[str] = RETAINED) -> DataFrame:
    """The tree after replacing ``existing`` by ``incoming`` while keeping the retained names.

    Existing files survive only below a retained top-level name, unless the incoming tree
    brings that name itself.
    """
    top = top_level(F.col(path))
    # At most one row per retained name, so the broadcast is bounded.
    brought = incoming.filter(top.isin(*retained)).select(top.alias("_top")).distinct()
    kept = existing.filter(top.isin(*retained)).withColumn("_top", top)
    survivors = kept.join(F.broadcast(brought), "_top", "left_anti").drop("_top")
    return survivors.select(*existing.columns).unionByName(incoming.select(*existing.columns))
