"""De-duplication of a feed as its files arrive."""
