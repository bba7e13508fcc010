"""Operators of a training-data pipeline: sharding, token shards, chat
formatting, quality, near duplicates, decontamination, sampled
segmentation, HTML extraction, language identification and nearest
neighbours. Nothing outside this subpackage imports it."""
