"""Curation of timed transcripts into audited clip manifests, as composable DataFrame operators."""
