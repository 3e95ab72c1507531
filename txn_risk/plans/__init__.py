"""The pipelines: staging, marts, quality, measures, reports, profiles, features and models."""
