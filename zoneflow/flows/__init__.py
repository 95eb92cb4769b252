"""End-to-end zone flows composed from the operators (landing -> trusted ->
exploitation), the way scheduled jobs use the library."""
