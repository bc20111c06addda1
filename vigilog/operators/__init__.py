"""DataFrame -> DataFrame operators.

Column conventions: an event table has the wire fields, ``ts`` (the parsed
time) and ``arrival_seq`` (a unique number that grows with arrival).
"""
