"""Landing of ticks and the five streaming queries over them."""
