"""Files in the shared folder, by URI, from driver or executors."""

from __future__ import annotations

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def put(uri: str, data) -> None:
    """Write one file; its folder is made where the store has folders."""
    store, path = opened(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)


def get(uri: str) -> bytes:
    store, path = opened(uri)
    with store.open_input_file(path) as f:
        return f.read()
