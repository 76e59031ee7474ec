"""Reusable physical-plan building blocks: distributed rank, dedup, sized broadcast."""
