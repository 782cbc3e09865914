"""Publishing one version: the model snapshot and the application files that serve it.

Nothing is written unless the gate was passed. The application tree is read, its placeholders
are filled in, it replaces the former tree except for retained names, and the result is a new
folder: a version once written is never changed.
"""

from __future__ import annotations

import ast
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from maskwright.operators import filetree, gate, registry
from maskwright.sources import files


@dataclass(frozen=True)
class PublishConfig:
    owner: str
    name: str
    prefix: str
    destination: str
    registry: str
    app: str | None = None
    previous_app: str | None = None
    tokens: Mapping[str, str] | None = None


def parse_settings(text: str | None) -> dict | None:
    """Settings given as a Python literal; None stays None. The application path is required."""
    if text is None:
        return None
    settings = ast.literal_eval(text)
    if "app_path" not in settings:
        raise RuntimeError("settings need an entry app_path: the folder with the application's files")
    return settings


def publish_version(spark: SparkSession, snapshot: DataFrame, blessing: DataFrame | None, config: PublishConfig,
                    clock: int, place: int | None = None) -> dict[str, str]:
    """Publish if allowed and record the attempt either way, at the run's place in the registry or the next.

    Returns what was recorded.
    """
    base = config.destination.rstrip("/")
    allowed = gate.is_blessed(blessing)
    record = {"pushed": str(int(allowed))}
    if allowed:
        version = f"v{int(clock)}"
        repo_id = f"{config.owner}/{config.name}"
        repo_url = f"{config.prefix.rstrip('/')}/{repo_id}"
        record |= {"pushed_version": version, "branch": version, "repo_id": repo_id}
        registry.publish(snapshot, None, f"{base}/model", clock)
        if config.app:
            values = filetree.placeholder_values(repo_id, repo_url, version, config.tokens)
            tree = filetree.replace_placeholders(files.read_tree(spark, config.app), values)
            if config.previous_app:
                tree = filetree.sync(files.read_tree(spark, config.previous_app), tree)
            record["space_url"] = f"{base}/app/version={version}"
            files.write_tree(tree, record["space_url"])
        registry.append_run(spark, config.registry, [("PushedModel", config.name, repo_url, record)], place)
    else:
        registry.append_run(spark, config.registry, [("PushedModel", config.name, "", record)], place)
    return record
