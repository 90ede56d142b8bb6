"""The HTTP sink of cards: JSON calls to a flashcard server, its note type and deck, and notes in batches."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sinks

# The server's defaults and names, which must equal the reference's for right results.
URL = "http://localhost:8765"
BATCH = 50
TIMEOUT_MS = 10000
API_VERSION = 6
NOTE_TYPE = "FSRS-3V"
FIELDS = ("Pergunta", "Resposta", "Tags", "Mnemônico", "Dificuldade", "Hint")
CARD_TEMPLATE = "Card 1"


def settings() -> tuple[str, int, int]:
    """URL, batch size and timeout in milliseconds, as the environment overrides them."""
    number = lambda name, default: int(v) if (v := os.environ.get(name, "")).isdigit() and int(v) else default
    return os.environ.get("ANKI_CONNECT_URL", URL), number("ANKI_BATCH_SIZE", BATCH), number("ANKI_TIMEOUT_MS", TIMEOUT_MS)


def client(url: str = URL, timeout_ms: int = TIMEOUT_MS) -> Callable:
    """call(action, params): the result of one request. An error in the answer, or no answer in time, raises."""

    def call(action: str, params: dict | None = None):
        body = json.dumps({"action": action, "version": API_VERSION, "params": params or {}}).encode()
        request = Request(url, body, {"Content-Type": "application/json"}, method="POST")
        try:
            with urlopen(request, timeout=timeout_ms / 1000) as answer:
                data = json.load(answer)
        except TimeoutError as e:
            raise TimeoutError(f"no answer from {url} within {timeout_ms} ms") from e
        if data.get("error"):
            raise RuntimeError(f"{action}: {data['error']}")
        return data.get("result")

    return call


def upsert_note_type(call: Callable, templates: dict) -> bool:
    """Creates the note type, or updates its styling and first template. True if it is new."""
    first = (templates["templates"] or [None])[0]
    if templates["name"] not in call("modelNames"):
        shown = [{"Name": CARD_TEMPLATE, "Front": first["qfmt"], "Back": first["afmt"]}] if first else []
        call("createModel", {"modelName": templates["name"], "inOrderFields": templates["fields"], "css": templates["css"], "cardTemplates": shown})
        return True
    call("updateModelStyling", {"model": {"name": templates["name"], "css": templates["css"]}})
    if first:
        call("updateModelTemplates", {"model": {"name": templates["name"], "templates": {CARD_TEMPLATE: {"Front": first["qfmt"], "Back": first["afmt"]}}}})
    return False


def push(notes: DataFrame, make: Callable[[], Callable], deck: str, batch: int = BATCH, note_type: str = NOTE_TYPE) -> DataFrame:
    """added, duplicates. deck: where the notes go. notes are those of csvlines.notes; make is called in each task for its client.
    A task that runs again sends its notes again: the server then answers that they are duplicates."""
    names = ("question", "answer", "tags", "mnemonic", "difficulty", "hint")

    def send(rows: list[dict]) -> list:
        call = make()
        return call("addNotes", {"notes": [{"deckName": deck, "modelName": note_type, "fields": dict(zip(FIELDS, (r[n] for n in names))), "tags": list(r["tag_list"])} for r in rows]})

    return sinks.push(notes.select(*[F.coalesce(n, F.lit("")).alias(n) for n in names], "tag_list"), send, batch)
