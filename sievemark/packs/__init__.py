"""Rule packs: what to look for, kept apart from how it is looked for."""

from sievemark.packs.model import Category, RulePack

__all__ = ["Category", "RulePack"]
