"""Files in shared folders, written through temporary names."""

from __future__ import annotations

import json
import uuid


def filesystem(uri: str):
    """pyarrow's file system and path of a folder's URI (a bare path is local)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def make_folder(folder: str) -> None:
    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)


class Committed:
    """An output file that gets its name only when it is complete; an attempt that dies leaves a file no reader looks for."""

    def __init__(self, folder: str, name: str):
        self.store, root = filesystem(folder)
        self.temporary, self.final = f"{root}/_{name}.{uuid.uuid4().hex}", f"{root}/{name}"
        self.out = self.store.open_output_stream(self.temporary, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        self.store.move(self.temporary, self.final)


def write_bytes(folder: str, name: str, data: bytes) -> None:
    f = Committed(folder, name)
    f.write(data)
    f.commit()


def read_bytes(folder: str, name: str) -> bytes:
    store, root = filesystem(folder)
    with store.open_input_stream(f"{root}/{name}", compression=None) as f:
        return f.read()


def write_manifest(folder: str, manifest: dict) -> None:
    write_bytes(folder, "manifest.json", json.dumps(manifest).encode())


def read_manifest(folder: str) -> dict:
    return json.loads(read_bytes(folder, "manifest.json"))
