"""Where data lies: a local folder or an object store. Credentials are left to the Hadoop configuration."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Location:
    mode: str
    root: str

    def __post_init__(self):
        if self.mode not in ("local", "cloud"):
            raise ValueError(f'mode must be "local" or "cloud", not {self.mode!r}')
        if not self.root:
            raise ValueError("a folder or a bucket is needed")

    def path(self, name: str) -> str:
        name = name.lstrip("/")
        if self.mode == "cloud":
            return f"s3a://{self.root.strip('/')}/{name}"
        return f"file:{self.root.rstrip('/')}/{name}"
