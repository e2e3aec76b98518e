"""The four jobs. Each plan is a DataFrame transform plus a ``run`` that writes."""
