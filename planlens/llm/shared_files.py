"""Small files in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from planlens.llm.warc import open_folder


def store(folder: str, name: str, data: bytes) -> None:
    """The whole file or none; a task that runs again replaces it by the same."""
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    draft = f"{path}/_{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(data)
    files.move(draft, f"{path}/{name}")


def fetch(folder: str, name: str) -> bytes | None:
    """The file's bytes, None if there is no such file."""
    files, path = open_folder(folder)
    try:
        with files.open_input_stream(f"{path}/{name}") as source:
            return source.read()
    except FileNotFoundError:
        return None
