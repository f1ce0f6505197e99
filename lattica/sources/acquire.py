"""Downloads in the driver: allowed hosts only, staged, checked, published by rename, never fetched twice."""

from __future__ import annotations

import hashlib
import os
import urllib.request
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path
from urllib.parse import urlparse

from ..operators.constraints import GateError


def host_allowed(url: str, hosts: Sequence[str]) -> bool:
    parts = urlparse(url)
    return parts.scheme == "https" and (parts.hostname or "") in hosts


def confined(path: Path, root: Path) -> Path:
    """``path`` under ``root``, links resolved; anything else fails."""
    full = path.resolve()
    if not full.is_relative_to(root.resolve()):
        raise GateError(f"{path} leaves {root}")
    return full


def acquire(url: str, target: Path, root: Path, hosts: Sequence[str], force: bool = False, opener: Callable = urllib.request.urlopen) -> dict:
    """Fetch one archive and give its event; ``opener`` stands in for the network in tests."""
    target = confined(target, root)
    if not host_allowed(url, hosts):
        raise GateError(f"host of {url} is not allowed")
    if target.exists() and not force:
        return {"url": url, "result": "skipped_existing", "byte_size": target.stat().st_size}
    part = target.with_name(target.name + ".part")
    try:
        with opener(url) as response, open(part, "wb") as out:
            final = response.geturl()
            if not host_allowed(final, hosts):
                raise GateError(f"redirect to {final} is not allowed")
            if response.status != 200:
                raise GateError(f"status {response.status} for {url}")
            digest, size = hashlib.sha256(), 0
            while block := response.read(1 << 20):
                out.write(block)
                digest.update(block)
                size += len(block)
            length = response.headers.get("Content-Length")
            if length is not None and int(length) != size:
                raise GateError(f"{size} bytes instead of {length} for {url}")
        with zipfile.ZipFile(part) as z:
            if z.testzip() is not None:
                raise GateError(f"{url} holds a broken member")
            members = len(z.namelist())
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)
    return {"url": url, "final_url": final, "result": "acquired", "byte_size": size, "sha256": digest.hexdigest(), "zip_member_count": members}


def page_metadata(url: str, hosts: Sequence[str], opener: Callable = urllib.request.urlopen) -> dict:
    """Hash and headers of a page, the host checked again after redirects."""
    if not host_allowed(url, hosts):
        raise GateError(f"host of {url} is not allowed")
    with opener(url) as response:
        if not host_allowed(response.geturl(), hosts):
            raise GateError(f"redirect to {response.geturl()} is not allowed")
        data = response.read()
        return {"url": url, "final_url": response.geturl(), "status": response.status, "sha256": hashlib.sha256(data).hexdigest(), "byte_size": len(data), "last_modified": response.headers.get("Last-Modified")}
