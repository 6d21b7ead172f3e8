"""retailcast: retail demand planning (forecast, backtest, inventory policy) on Spark."""

__version__ = "0.1.0"
