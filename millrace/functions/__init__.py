"""Column -> Column helpers, only where a Spark built-in alone has other null, error or
length semantics than the jobs need. Everything else is called on the built-ins directly."""
