from __future__ import annotations

import argparse


def pairs(items: list[str]) -> dict[str, str]:
    """`key=value` arguments as reader or writer options."""
    return dict(item.split("=", 1) for item in items)


def add_format(parser: argparse.ArgumentParser, name: str, default: str | None) -> None:
    parser.add_argument(f"--{name}-format", default=default)
    parser.add_argument(f"--{name}-option", action="append", default=[], metavar="KEY=VALUE")
