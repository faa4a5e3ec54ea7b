"""Training-data operators on document, conversation and embedding tables.

Nothing outside this subpackage imports it. Each module holds one operator with its own
interface; ``queries`` holds the registered queries and their SQL.
"""
