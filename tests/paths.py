"""Where the driver's tables are; a module of its own, as every test folder
may have its own ``conftest``."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
