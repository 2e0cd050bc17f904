"""The term lists and the label map that the matchers and reports work on."""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
# The lists below are given facts: their spelling (padding spaces included) and
# their order are part of every result. They are not derived from anything.

FRAMEWORKS = [
    "Docker", "OSP", "Premiere", "directAdmin", "typography", "Prometheus", "visual weight",
    "Kubernetes", "JDBC", "UnitTest", "Servlets", "cPanel", "MySQL", ".NET", "Ruby on Rails", "JSP",
    "IdentityServer", "VoIP", "AdobeXD", "CMake", "Autocad", "Spring", "Django", "CRM", "K8S",
    "Nginx", "firmware", "Google Trend", "psd", "CSRF", "Reactjs", "Struts", "WebSocket", "Webpack",
    "Spine", "Vue", "METEOR", "Rancher", "VFX", "node js", "Angular", "Flask", "ASP.NET",
    "Google Analystics", "Zend", "Symfony", "Express", "Google Protobuf", "J2EE", "Ansible",
    "WebForm", "Videoscribe", "CakePHP", "Hibernate", "Git", "Oracle", "Plesk", "Log4j", "JSON",
    "Visio", "Grafana", "SDLC", " EELinux", " Redis", "Redux", "WinForm", "Figma", "CodeIgniter",
    "Power BI", "Bootstrap", "WPF", "Aerospike", "bash shell", "Laravel", "SQL Server",
]

LANGUAGES = [
    " CHAIN ", " ABAP ", "Lingo", " CPL", "NPL", "Xtend", " Flex ", " Io ", "Erlang", "Python",
    "MSL", "SAIL", " Chef ", "RPG", "PHP", "XPath", "Lava", " Clojure", "Mathematica", "QPL", "Oak",
    "Objective-C", "P#", "css", " Delphi", " A+ ", "XQuery", "CoffeeScript", " SR ", "ECMAScript",
    "Nial", " Red ", "Mesa", "LSL", "T-SQL", "E#", " GAP ", "Simula", "Logo", " Caml", "JavaScript",
    "PeopleCode", " UNITY ", " Blue ", "Span", "Lucid", " BeanShell", " CSP", "Scheme", "Swift",
    "TypeScript", " Scala ", "Scratch", "Strand", "XML", " SAS", "PortablE", "JADE", " C ",
    "Processing", "Pure", " BASIC ", " Bash", "Pro*C", "ROOP", "PL/SQL", "Icon", " Dart",
    " Factor ", "Java", "LINC", " Go ", " TIE ", " Cool", "Kotlin", "Rust", "Opa", "DYNAMO",
    " Inform ", "Mary", "Ruby", "YQL", "Pike", " rc ", " html ", "Oz", "Groovy", "PowerShell",
    " CUDA", "Hack", " Self ", " CFEngine", "C#", "SPS",
]

DESIGN_PATTERNS = [
    "design pattern", "MVC", " Singleton", " WPF", " MVVM", "Session Facade", " DAO ", "OOA/OOD",
    "Factory Pattern", "Microservice",
]

KNOWLEDGES = [
    "game", "Jira", "lắp đặt", "interaction design", "đồ họa", "DevOps", " AI ", " async",
    "Quality Assurance", " Security ", "Google Drive", "NFT", "mạng máy tính", "Wordpress",
    "Machine Learning", "Consult", "White Box", "sale", "kiểm thử", "đánh giá chất lượng",
    "networking", "distributed system", "UI/UX", "Windows", "Unit Test", "Jenkins", "Chatbot",
    "quản trị mạng", "Solidity", "tester", "Corel Draw", "Illustrator", "Git", "Android",
    "Black Box", "Office", "chạy quảng cáo", "Unix", "IT Support", "Data mining", "data analys",
    "cấu trúc dữ liệu", "Switch", " TCP", "qa", "Animate", "crypto", "CI/CD", "Defi", "frontend",
    "sửa chữa", "SVN", "phần cứng", " sync", "Powerpoint", "smart contract", "Linux", "SCM",
    "backend", "Marketing", "XSS", "Photoshop", "HTTP", "Word", "router", "IOS", "WebSocket",
    "thuật toán", "TestRail", "CSDL", "Sketch", "blockchains", "multithreading",
    "hướng đối tượng", "Front-end", "latex", "Restful", "Subversion", "java web", "Mobile", "Excel",
]

# Category of a knowledge term; the key is matched exactly, spaces included.
KNOWLEDGE_LABELS = {
    " AI": "AI", "Machine Learning": "AI", "Data mining": "AI", "Chatbot": "AI",
    "data analys": "AI",
    "blockchains": "blockchain_crypto", "crypto": "blockchain_crypto", "NFT": "blockchain_crypto",
    "smart contract": "blockchain_crypto", "Solidity": "blockchain_crypto",
    "Defi": "blockchain_crypto", "XSS": "blockchain_crypto", " Security ": "blockchain_crypto",
    "lắp đặt": "hardware", "sửa chữa": "hardware", "phần cứng": "hardware", "router": "hardware",
    "Corel Draw": "hardware", "Switch": "hardware",
    "Word": "office", "Excel": "office", "Powerpoint": "office", "Office": "office",
    "Illustrator": "photoshop", "Photoshop": "photoshop", "Animate": "photoshop",
    "cấu trúc dữ liệu": "programming_basic", "thuật toán": "programming_basic",
    "OOP": "programming_basic", "hướng đối tượng": "programming_basic",
    "Black Box": "tester", "tester": "tester", "White Box": "tester", "Unit Test": "tester",
    "TestRail": "tester", "kiểm thử": "tester",
    "SVN": "version_control", "SCM": "version_control", "Git": "version_control",
}
# --- End of fixed values ----------------------------------------------------
