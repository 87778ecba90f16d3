"""Operators for building training corpora at scale.

Nothing outside this subpackage imports it; its queries are added to the entry
module only when the subpackage is present.
"""
