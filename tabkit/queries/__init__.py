"""Registered queries, one per operator, each with its SQL counterpart where SQL can express it."""
