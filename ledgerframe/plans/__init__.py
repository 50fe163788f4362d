"""Composition of operators into marts, report sections and full runs."""

from .marts import Marts, build_marts

__all__ = ["Marts", "build_marts"]
