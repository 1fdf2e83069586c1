"""DataFrame operators over trades and hourly bars."""
