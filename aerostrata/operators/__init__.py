"""DataFrame operators of the Silver, Gold and meta layers."""
