"""The configuration of a run: where sources and outputs are, and what the document is called."""

from __future__ import annotations

import functools
import json
import os

# The names of the file's fields, which must equal the reference's for right results.
SOURCES = ("json", "markdown", "imageDir")
OUTPUTS = ("baseDir", "document", "figureMap", "content")
DOCUMENT = ("id", "title", "author")


def check(config: dict) -> dict:
    """config; ValueError names the first field that is missing or empty."""
    for part, names, what in (("sources", SOURCES, "source path"), ("output", OUTPUTS, "output path"), ("document", DOCUMENT, "document field")):
        for name in names:
            if not (config.get(part) or {}).get(name):
                raise ValueError(f"missing {what}: {name}")
    return config


@functools.lru_cache
def load(path: str) -> dict:
    """The checked file, read once; load.cache_clear() forgets it."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"no configuration at {path}")
    with open(path, encoding="utf-8") as f:
        return check(json.load(f))


def output(config: dict, name: str) -> str:
    """The path of an output below the base folder, or that folder."""
    base = config["output"]["baseDir"]
    return base if name == "baseDir" else f"{base}/{config['output'][name]}"
