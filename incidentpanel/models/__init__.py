"""Baselines, per-entity and pooled models, screening GLMs."""
