"""Corpus screening on Spark: rule packs in, kept and flagged documents out."""

from sievemark.operators.screen import ScreenConfig, screen, screen_categories, screen_explicit
from sievemark.packs import Category, RulePack

__all__ = ["Category", "RulePack", "ScreenConfig", "screen", "screen_categories", "screen_explicit"]
