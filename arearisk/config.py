"""Where staged inputs, processed tables and outputs live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Catalogue:
    """Folder layout of one run: raw inputs, processed indicators, outputs."""

    root: str = "./data"
    output_root: str = "./output"

    def raw(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), "raw", *parts])

    def processed(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), "processed", *parts])

    def output(self, *parts: str) -> str:
        return "/".join([self.output_root.rstrip("/"), *parts])
