"""tidepool: set-based Spark operators for streams of short customer messages.

Every public function takes and returns DataFrames; nothing is collected to the driver.
"""

__version__ = "0.1.0"
