"""Where the repository and the test tables are."""

from __future__ import annotations

from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
