"""What the driver and the tests run: input mapping, query registry and SQL oracle."""
