"""Files that tasks open by themselves, in any store that Arrow reaches."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterable, Iterator
from fnmatch import fnmatch
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs


def _has_scheme(uri: str) -> bool:
    return uri.partition("/")[0].endswith(":")


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it of a URI, whose letters need not all be escaped, or of a local path."""
    if not _has_scheme(uri):
        return pafs.FileSystem.from_uri(uri)
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(quote(uri, safe=string.punctuation))


def open_input(uri: str) -> pa.NativeFile:
    system, path = store(uri)
    return system.open_input_file(path)


def files_below(uri: str, pattern: str = "*") -> Iterator[str]:
    """The URI of a file, or of the files in a folder and below whose base name matches, in order."""
    system, path = store(uri)
    info = system.get_file_info(path)
    if info.type == pafs.FileType.File:
        yield uri
        return
    base = path.rstrip("/")
    found = system.get_file_info(pafs.FileSelector(path, recursive=True))
    for one in sorted(x.path for x in found if x.type == pafs.FileType.File):
        hidden = any(part.startswith(("_", ".")) for part in one[len(base) + 1:].split("/"))
        if not hidden and fnmatch(one.rsplit("/", 1)[-1], pattern):
            name = one[len(base) + 1:]
            yield f"{uri.rstrip('/')}/{quote(name) if _has_scheme(uri) else name}"


def write_new(folder: str, ending: str, parts: Iterable[bytes]) -> str:
    """A new file in a shared folder, under a name that no other attempt of a task takes; its URI."""
    system, path = store(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{ending}"
    with system.open_output_stream(f"{path.rstrip('/')}/{name}", compression=None) as out:
        for part in parts:
            out.write(part)
    return f"{folder.rstrip('/')}/{name}"
