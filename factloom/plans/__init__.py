"""Registered queries, their SQL counterparts, and plan inspection."""
