"""Training-data operators: packing, near-duplicate search, fingerprints, chat
formatting, mixing, language identification, token counts and token shards.

Nothing outside this subpackage imports it.
"""
